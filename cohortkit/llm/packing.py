"""Best-fit packing of token pieces by the sum of squared gap counts.

A document is cut into pieces of at most ``capacity`` ids (only the first piece
of a longer one may be shorter).  Full pieces are sequences of their own.  The
others are dealt over groups of bounded size, and each group is packed on its
own: a piece goes where the sum over all residual gaps of (open sequences with
this gap) squared becomes smallest, ties to the smaller gap.

Nulls and empty texts hold the end id alone.  Repeated rows are packed one by
one.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, lean_group, materialize
from .tokens import encoder, slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text", memo_words: int = 500_000, chars: int = 4 << 20) -> DataFrame:
    """One row per piece, with the checksum of its ids as little-endian 32-bit integers.

    A smaller memo of ``memo_words`` and slices of fewer ``chars`` bytes cost time and spare memory, with the same rows.
    """

    @lean
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, memo_words)
        for batch in batches:
            doc, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts, chars):
                ids, bounds = enc.encode_column(texts.slice(a, b - a))
                rows: list[tuple] = []
                for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                    whole = np.append(ids[lo:hi], end_id).astype("<u4")
                    for k, (s, n) in enumerate(cut_points(len(whole), capacity)):
                        rows.append((a + i, k, s, n, zlib.crc32(whole[s : s + n])))
                at, *rest = (pa.array(c) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [doc.take(at).cast(pa.int64()), rest[0].cast(pa.int32()), *rest[1:]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, longest pieces first.

    Memory is one entry per piece and one per gap.  Of the open sequences with
    the chosen gap the oldest is taken.
    """
    n = np.zeros(capacity + 1, np.int64)  # open sequences by gap; a full one is not counted
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        cost = 2 * (n[: capacity - s] - n[s:capacity]) + 2  # from gap s + k to gap k
        cost[0] = 1 - 2 * n[s] if capacity > s else 0
        cost[n[s:capacity] == 0] = np.iinfo(np.int64).max
        k = int(np.argmin(cost))
        if n[s + k] and cost[k] <= 2 * n[capacity - s] + 1:
            gap = s + k
            b = heapq.heappop(gaps[gap])
            n[gap] -= 1
        else:
            gap, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            n[gap - s] += 1
            heapq.heappush(gaps[gap - s], b)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int, group_rows: int = 1 << 16) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``group_rows`` bounds the pieces that one task packs; groups are filled by a
    hash of a row number, so no key can make one large.
    """
    names = pieces.columns
    kept = materialize(pieces.withColumn("uid_", F.monotonically_increasing_id()), "pieces")
    short = kept.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_rows))

    @lean_group
    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = sum_of_squares(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = (pdf["group_"].to_numpy(np.int64) << 32) + bins
        pdf["offset"] = offsets
        return pdf[[*names, "sequence_id", "offset"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    grouped = short.withColumn("group_", F.pmod(F.xxhash64("uid_"), F.lit(groups)))
    packed = grouped.groupBy("group_").applyInPandas(place, schema)
    full = kept.filter(F.col("length") >= capacity).select(*names, (-1 - F.col("uid_")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
