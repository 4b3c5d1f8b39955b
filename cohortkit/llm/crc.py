"""CRC-32 of many byte spans at once.

The register is linear over XOR: a byte adds a value that depends only on the
byte and on how many bytes follow it, and the register's start adds one that
depends only on the length.  So the checksum of a span is the XOR of table entries
``[distance from the end, byte]``, taken for all spans by one ``reduceat``, and a
length constant.  Spans longer than the table are cut into blocks, counted from
the end; neighbouring blocks are folded, the left one shifted by the right one's
bytes, until one value is left.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: The reflected polynomial and the start of the register.
POLYNOMIAL, START = np.uint32(0xEDB88320), np.uint32(0xFFFFFFFF)
#: Bytes of a block, a power of two.
BLOCK = 256


@lru_cache(1)
def contributions() -> np.ndarray:
    """``[distance, byte]``: what a byte adds that so many bytes follow."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> np.uint32(1)) ^ POLYNOMIAL, one >> np.uint32(1))
    rows = [one]
    for _ in range(BLOCK - 1):
        rows.append(one[rows[-1] & 255] ^ (rows[-1] >> np.uint32(8)))
    return np.array(rows)


def _apply(shift: np.ndarray, x: np.ndarray) -> np.ndarray:
    return shift[0][x & 255] ^ shift[1][(x >> np.uint32(8)) & 255] ^ shift[2][(x >> np.uint32(16)) & 255] ^ shift[3][x >> np.uint32(24)]


@lru_cache(64)
def shift_by(power: int) -> np.ndarray:
    """``[byte's place, byte]``: what a register's byte becomes after ``2**power`` zero bytes."""
    if power == 0:
        x = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
        return contributions()[0][x & 255] ^ (x >> np.uint32(8))
    half = shift_by(power - 1)
    return _apply(half, half)


def length_constants(size: np.ndarray) -> np.ndarray:
    """The checksum of so many zero bytes: start and end value of the register."""
    kinds, index = np.unique(size, return_inverse=True)
    x = np.full(len(kinds), START)
    for power in range(int(kinds.max(initial=0)).bit_length()):
        on = (kinds >> power) & 1 == 1
        x[on] = _apply(shift_by(power), x[on])
    return (x ^ START)[index]


def crc32_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of ``data[start[i]:end[i]]``; spans may overlap and may be empty."""
    size = (end - start).astype(np.int64)
    out = length_constants(size)
    some = np.flatnonzero(size > 0)
    if not len(some):
        return out
    blocks = -(-size[some] // BLOCK)
    span = np.repeat(some, blocks)
    after = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(span))  # blocks of the span that follow
    stop = end[span] - after * BLOCK
    begin = np.maximum(stop - BLOCK, start[span])
    length = stop - begin
    at = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(at - begin, length)
    distance = np.repeat(stop - 1, length) - place
    value = np.bitwise_xor.reduceat(contributions().ravel()[distance * 256 + data[place]], at)
    power = BLOCK.bit_length() - 1
    while after.max() > 0:
        value = np.where(after & 1 == 1, _apply(shift_by(power), value), value)
        pair = after >> 1
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (span[1:] != span[:-1])]))
        value, after, span, power = np.bitwise_xor.reduceat(value, new), pair[new], span[new], power + 1
    out[span] ^= value
    return out
