"""Importance resampling of documents towards a target text collection.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
with A-Z lower-cased; a feature is 1 to ``most`` consecutive words, joined by one
space, and falls into the bucket that is its CRC-32 modulo ``buckets`` (see
``crc``: one table look-up a byte and one XOR reduction for all features of a
batch).  Two tables of bucket counts, over all documents and all target texts,
give a gain for each bucket; a document's weight is the floored mean of its
features' gains.  Adding hashed Gumbel noise and taking the highest scores draws
without replacement in proportion to the weights.

Only bucket counts, a table of ``buckets`` rows, reach the driver.  Ranks come
from a histogram of the integer scores: rows of one score are ordered among
themselves, and the rows above them are added from the histogram.

Null and empty texts have no features and the weight 0.  A null id is hashed as
no digits and is last among ties; repeated rows get ranks of their own, one after
the other.  Without target texts every count of the target is 0.  An empty table
gives an empty result, and other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize
from .crc import crc32_spans
from .shingles import LOWER
from .tokens import slices

#: Bytes of words, after lower-casing: digits, a-z and all of UTF-8's multi-byte characters.
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Features:
    most: int = 1
    buckets: int = 10_000


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased bytes of a string column (null: none) and the bounds of its texts."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, 8 * raw.offset)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return LOWER[data], offsets - offsets[0]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; words end where their text ends."""
    inside = IN_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    start = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def feature_buckets(texts: pa.Array, spec: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and bucket and text number of every feature."""
    data, bounds = bytes_of(texts)
    start, end, doc = word_spans(data, bounds)
    words = np.bincount(doc, minlength=len(texts))
    if spec.most > 1:  # words with one space behind each
        size = end - start + 1
        to = np.cumsum(size)
        source = np.arange(int(size.sum())) - np.repeat(to - size - start, size)
        data = np.append(data, np.uint8(32))[np.minimum(source, len(data))]
        data[to - 1] = 32
        start, end = to - size, to - 1
    buckets, docs = [], []
    for n in range(1, spec.most + 1):
        first = np.arange(max(0, len(start) - n + 1))
        first = first[doc[first] == doc[first + n - 1]]
        buckets.append(crc32_spans(data, start[first], end[first + n - 1]).astype(np.int64) % spec.buckets)
        docs.append(doc[first])
    return words, np.concatenate(buckets), np.concatenate(docs)


def bucket_counts(texts: DataFrame, spec: Features, text_col: str = "text") -> np.ndarray:
    """How many features of all rows fall into each bucket; each task sends at most one row a bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(spec.buckets, np.int64)
        for b in batches:
            for lo, hi in slices(b.column(0)):
                n += np.bincount(feature_buckets(b.column(0).slice(lo, hi - lo), spec)[1], minlength=spec.buckets)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n[held])], names=["bucket", "n"])

    out = np.zeros(spec.buckets, np.int64)
    for bucket, n in texts.select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down."""
    all_s, all_t, k = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + k) / ((s + 1.0) * (all_t + k)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, spec: Features, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, n_words, n_features, weight`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, count, total = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lo, hi in slices(b.column(2)):
                w, bucket, doc = feature_buckets(b.column(2).slice(lo, hi - lo), spec)
                n, order = np.bincount(doc, minlength=hi - lo), np.argsort(doc, kind="stable")
                s = np.concatenate([[0], np.cumsum(gains[bucket[order]])])
                ends = np.cumsum(n)
                words.append(w), count.append(n), total.append(s[ends] - s[ends - n])
            n = np.concatenate(count)
            mean = np.concatenate(total) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.concatenate(words).astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(mean)], names=names)

    names = [id_col, *(fresh([id_col], c) for c in ("text_hash", "n_words", "n_features", "weight"))]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    return docs.select(id_col, F.xxhash64(text_col), text_col).mapInArrow(run, schema)


def noise(seed: int, id_col: str = "doc_id"):
    """Thousandths of a Gumbel draw, from the hash of the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def draw(scored: DataFrame, eligible, percent: int, id_col: str = "doc_id") -> DataFrame:
    """``scored`` (a written table) with ``rank``: 1, 2, .. by descending ``score`` for the drawn share of eligible rows."""
    open_rows = scored.filter(eligible)
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)  # one row for each value of the integer score
    steps = open_rows.groupBy("score").agg(F.count(F.lit(1)).alias("rows_")).withColumn("above_", F.coalesce(F.sum("rows_").over(above), F.lit(0)))
    take = F.floor(open_rows.agg(F.count(F.lit(1))).scalar() * percent / 100).cast("long")
    steps = steps.select(F.col("score").alias("score_"), "above_")
    joined = scored.join(steps, eligible & (F.col("score") == F.col("score_")), "left")
    reach = F.coalesce(F.col("above_") < take, F.lit(False))
    here = Window.partitionBy("score").orderBy(F.asc_nulls_last(id_col))
    inside = joined.filter(reach).withColumn("rank", F.row_number().over(here) + F.col("above_"))
    inside = inside.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")).cast("long"))
    return inside.unionByName(joined.filter(~reach).withColumn("rank", F.lit(None).cast("long"))).drop("score_", "above_")


def importance_ranks(docs: DataFrame, target: DataFrame, spec: Features = Features(), seed: int = 2024, least_words: int = 20, percent: int = 10,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, n_words, n_features, weight, score, rank`` of every row of ``docs``; undrawn rows have no rank."""
    gains = bucket_gains(bucket_counts(docs, spec, text_col), bucket_counts(target, spec, text_col))
    scored = weigh(docs, gains, spec, id_col, text_col).withColumn("score", F.col("weight") + noise(seed, id_col))
    scored = materialize(scored, "importance-scores")
    return draw(scored, F.col("n_words") >= least_words, percent, id_col)


def resample(docs: DataFrame, target: DataFrame, spec: Features = Features(), seed: int = 2024, least_words: int = 20, percent: int = 10,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; rows with one id and one text are drawn together."""
    ranked = importance_ranks(docs, target, spec, seed, least_words, percent, id_col, text_col).filter("rank IS NOT NULL")
    i, h = (fresh(docs.columns, n) for n in ("drawn_id", "drawn_hash"))
    drawn = ranked.select(F.col(id_col).alias(i), F.col("text_hash").alias(h)).distinct()
    return docs.join(drawn, F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(h)), "left_semi")
