"""Positions along Hilbert curves, vectorised over points."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The position of each point of an integer grid (``n x dims``, below ``2**bits``) as ``uint64``.

    Walks the bits from the top: in each cube of the curve the point is reflected
    and its axes exchanged into the frame of the sub-cube it lies in; the bits so
    turned are then Gray-decoded and interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    if dims * bits > 64:
        raise ValueError("dims * bits must not exceed 64")
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        below = np.uint64((1 << level) - 1)
        for axis in range(dims):
            flip = (x[axis] & bit) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[axis]) & below)
            x[0] = np.where(flip, x[0] ^ below, x[0] ^ swap)
            x[axis] ^= swap if axis else np.uint64(0)
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    carry = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        carry = np.where(x[-1] & bit, carry ^ np.uint64((1 << level) - 1), carry)
    x ^= carry
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = (key << np.uint64(1)) | ((x[axis] >> np.uint64(level)) & np.uint64(1))
    return key
