"""Byte strings compared by prefix polynomial hashes, vectorised.

A prefix hash array answers whether two substrings are equal in constant time;
binary search over the length gives the common extension of two suffixes, and so
their order, in logarithmic time.  Mergesort uses that comparison, and equal
neighbours are then compared byte by byte, so a hash collision changes nothing.
"""

from __future__ import annotations

import numpy as np

from .shingles import BASE, mix, powers

POSITION_BITS = 31  # of a text, whose size Spark limits to 2 GB; the rest of a word holds the hash that orders grams


#: The byte values and base of a second polynomial, unrelated to those of the first.
OTHER_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
OTHER_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))


def prefix_hashes(data: np.ndarray, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial in the bytes, and the inverse powers that shift a substring to the origin."""
    up, down = powers(len(data) + 1, OTHER_BASE if second else BASE)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = OTHER_BYTES[data] if second else data.astype(np.uint64) + np.uint64(1)
    np.cumsum(values * up[: len(data)], out=sums[1:])
    return sums, down


def gram_hashes(sums: np.ndarray, down: np.ndarray, n: int) -> np.ndarray:
    """Unmixed hashes of all substrings of ``n`` bytes."""
    count = len(sums) - n
    return (sums[n:] - sums[:count]) * down[:count]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the smallest gram of every ``length``-byte window, with the windows each one stands for.

    Returns the anchors, and for each the first window start and the number of
    (consecutive) windows whose smallest gram it is.  Equal windows choose the
    same place, wherever they stand.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none
    sums, down = prefix_hashes(data)
    order = gram_hashes(sums, down, gram) * np.uint64(0xD6E8FEB86659FD93)
    packed = (order >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | np.arange(len(order), dtype=np.uint64)
    place = (sliding_min(packed, length - gram + 1) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[first], first, np.diff(np.append(first, len(place)))


def extension(sums: np.ndarray, down: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Length of the common beginning of the suffixes at ``x`` and ``y``, at most ``most``."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), most, np.int64)
    dx, dy, sx, sy = down[x], down[y], sums[x], sums[y]
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) >> 1
        same = (sums[x + mid] - sx) * dx == (sums[y + mid] - sy) * dy
        low = np.where(same & open_, mid, low)
        high = np.where(same | ~open_, high, mid - 1)


def sort_suffixes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """The order of the ``length``-byte strings at ``starts`` within their groups (``group`` is ascending).

    Bottom-up mergesort of all groups at once: an element's place in a merged run
    is its place in its own run plus its rank in the other, by binary search.
    """
    sums, down = prefix_hashes(data)
    n = len(starts)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(first, n))
    base, count = np.repeat(first, size), np.repeat(size, size)
    order, width = np.arange(n), 1
    largest = int(size.max()) if n else 0
    while width < largest:
        spot = np.flatnonzero(count > width)
        place = spot - base[spot]
        run = place // width
        other = run ^ 1
        low = np.minimum(other * width, count[spot])
        high = np.minimum(low + width, count[spot])
        begin = low.copy()
        mine, right = starts[order[spot]], (run & 1).astype(bool)
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            mid = (low[live] + high[live]) >> 1
            x, y = mine[live], starts[order[base[spot[live]] + mid]]
            common = extension(sums, down, x, y, length)
            at = np.minimum(common, length - 1)
            less = (common < length) & (data[y + at] < data[x + at])
            before = less | (right[live] & (common >= length))  # equal elements of the left run come first
            low[live] = np.where(before, mid + 1, low[live])
            high[live] = np.where(before, high[live], mid)
        target = base[spot] + np.minimum(run, other) * width + (place - run * width) + (low - begin)
        moved = order.copy()
        moved[target] = order[spot]
        order = moved
        width *= 2
    return order


def equal_classes(data: np.ndarray, starts: np.ndarray, order: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """A class number for each element in ``order``; members have the same group and the same ``length`` bytes."""
    n = len(order)
    if not n:
        return np.zeros(0, np.int64)
    same = np.zeros(n, bool)
    near = np.flatnonzero(group[1:] == group[:-1])
    span = np.arange(length)
    for i in range(0, len(near), 1 << 16):
        k = near[i : i + (1 << 16)]
        same[k + 1] = (data[starts[order[k]][:, None] + span] == data[starts[order[k + 1]][:, None] + span]).all(axis=1)
    return np.cumsum(~same) - 1


def gram_keys(data: np.ndarray, places: np.ndarray, gram: int) -> np.ndarray:
    """Mixed hashes of the grams at ``places``."""
    sums, down = prefix_hashes(data)
    return mix((sums[places + gram] - sums[places]) * down[places])


def surroundings(size: int, places: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of all that a ``length``-byte window around each gram of a text of ``size`` bytes can reach."""
    return np.maximum(places - (length - gram), 0), np.minimum(places + length, size)


def context_keys(data: np.ndarray, places: np.ndarray, gram: int, length: int) -> np.ndarray:
    """128-bit hashes of the surroundings of each gram and its place in them: two unrelated polynomials, a column each."""
    low, high = surroundings(len(data), places, gram, length)
    out = np.zeros((len(places), 2), np.uint64)
    for column in range(2):
        sums, down = prefix_hashes(data, second=column == 1)
        key = mix((sums[high] - sums[low]) * down[low] + (places - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, column] = mix(key + (high - places).astype(np.uint64))
    return out
