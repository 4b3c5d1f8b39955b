"""Sets of word shingles as sorted 64-bit hashes, vectorised over a text."""

from __future__ import annotations

import hashlib

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so its powers have inverses modulo 2**64
_POWERS: dict[int, list[np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base``, which is odd, and of its inverse."""
    held = _POWERS.setdefault(int(base), [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    if len(held[0]) < n:
        size = 1 << n.bit_length()
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        for i, b in enumerate((base, inverse)):
            full = np.full(size, b, np.uint64)
            full[0] = 1
            held[i] = np.cumprod(full)
    return held[0], held[1]


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word: runs of bytes other than ASCII blanks, A-Z lowered."""
    data = LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    blank = np.concatenate([[True], BLANK[data], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of ``k`` consecutive words; of all words, if there are fewer; none without words."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.full(len(w) - n + 1, np.uint64(n), np.uint64)
    for i in range(n):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w[i : len(w) - n + 1 + i])
    return np.unique(h)


def set_id(hashes: np.ndarray) -> bytes:
    """16 bytes that stand for the whole set."""
    return hashlib.blake2b(hashes.astype("<u8").tobytes(), digest_size=16).digest()


def odd_sketch(hashes: np.ndarray, bits: int) -> bytes:
    """Parities of the hashes that fall on each of ``bits`` (a power of two) places.

    Two sketches differ in at most as many places as their sets do.
    """
    places = np.bincount((mix(hashes) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(places.astype(np.uint8), bitorder="little").tobytes()


def sketch_difference(a: bytes, b: bytes) -> int:
    """Places in which two sketches differ, the longer folded to the shorter's length."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    la, lb = len(a), len(b)
    while la > lb:
        la //= 2
        x = (x >> (8 * la)) ^ (x & ((1 << (8 * la)) - 1))
    while lb > la:
        lb //= 2
        y = (y >> (8 * lb)) ^ (y & ((1 << (8 * lb)) - 1))
    return (x ^ y).bit_count()
