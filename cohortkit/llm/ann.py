"""Nearest neighbours by shifted Hilbert orderings of projected vectors.

Equal vectors are one class.  Each of ``curves`` indexes projects the classes
with its own random rotation onto ``dims`` axes, shifts them at random in a grid
and orders them along a Hilbert curve; Spark range-partitions all orderings.  A
query class takes the ``window`` (a share of all classes) before and after it on
every curve, measures true distances there, and the best of all curves merge.

Vectors that are null, zero, of a length other than the most frequent one, or
hold null or non-finite components take no part.  Rows with the query's id are
its own and no candidates.  A null id is no candidate and no query.  Ties go to
the smaller id; a query with fewer candidates gets all that were found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions
from .hilbert import hilbert_keys


def vector_classes(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """``cid, vec, ids`` of the distinct usable vectors; ``ids`` are the ``k + 1`` smallest.

    The limit of a row number is applied before the shuffle too, so a vector on
    a third of all rows costs each task ``k + 1`` rows.
    """
    v = F.col("vec")
    usable = (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")
              .filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)))
    size = usable.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).limit(1)
    usable = usable.join(F.broadcast(size.select("n")), F.size("vec") == F.col("n")).select("id", "vec")  # one row
    first = usable.distinct().withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("r") <= k + 1)
    grouped = first.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return materialize(grouped.select(F.monotonically_increasing_id().alias("cid"), "vec", "ids"), "vector-classes")


class Curves:
    """Random rotations and shifts; the grid is fitted on a bounded sample, cells beyond it are clipped."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        width = sample.shape[1]
        dims = min(dims, width)
        self.bits, self.centre = bits, sample.mean(axis=0)
        self.axes = [np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dims] for _ in range(curves)]
        self.low, self.span, self.shift = [], [], []
        for a in self.axes:
            p = (sample - self.centre) @ a
            self.low.append(p.min(axis=0))
            self.span.append(max(float((p.max(axis=0) - p.min(axis=0)).max()), 1e-12))
            self.shift.append(rng.random(dims))

    def keys(self, vectors: np.ndarray) -> Iterator[np.ndarray]:
        for a, low, span, shift in zip(self.axes, self.low, self.span, self.shift):
            cell = (((vectors - self.centre) @ a - low) / span + shift) / 2 * (1 << self.bits)
            yield hilbert_keys(np.clip(cell, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def curve_ranks(classes: DataFrame, curves: Curves) -> DataFrame:
    """``curve, rank, cid``: the place of every class on every curve."""

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for c, key in enumerate(curves.keys(matrix(batch.column(1)))):
                    signed = (key ^ np.uint64(1 << 63)).view(np.int64)  # the same order among signed numbers
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(signed), batch.column(0)], names=["curve", "key", "cid"])

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            yield batch.append_column("at", pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64)))
            at += batch.num_rows

    keys = classes.select("cid", "vec").mapInArrow(keyed, "curve int, key long, cid long")
    ranged = keys.repartitionByRange(shuffle_partitions(classes.sparkSession), "curve", "key", "cid").sortWithinPartitions("curve", "key", "cid")
    placed = materialize(
        ranged.select("curve", "cid", F.spark_partition_id().alias("part")).mapInArrow(numbered, "curve int, cid long, part int, at long"), "curve-order")
    parts = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = parts.select("curve", "part", (before - F.col("low")).alias("base"))
    return placed.join(bases, ["curve", "part"]).select("curve", (F.col("at") + F.col("base")).alias("rank"), "cid")


def nearest(vectors: DataFrame, is_query, k: int = 10, curves: int = 20, dims: int = 8, bits: int = 6, window: float = 0.025,
            sample_rows: int = 4096, cell_rows: int = 2048, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score`` of the ``k`` nearest found for each row whose id fits ``is_query(column)``.

    ``sample_rows`` bounds the sample that fits the grids; every class is indexed.
    ``cell_rows`` bounds the classes that one group compares with its queries.
    """
    classes = vector_classes(vectors, id_col, vec_col, k)
    wanted = vectors.select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("vec")).filter(is_query(F.col("query_id"))).distinct()
    queries = materialize(wanted.join(classes.select("cid", "vec"), "vec").select("query_id", "cid"), "ann-queries")
    sample = classes.orderBy(F.xxhash64("cid")).limit(sample_rows).select("vec").collect()
    schema = f"query_id {vectors.schema[id_col].dataType.simpleString()}, rank int, {id_col} {vectors.schema[id_col].dataType.simpleString()}, score double"
    if not sample:
        return vectors.sparkSession.createDataFrame([], schema)
    total = classes.count()
    reach = max(k, int(np.ceil(window * total)))
    ranks = curve_ranks(classes, Curves(np.array([r.vec for r in sample], np.float64), curves, dims, bits, seed))
    asking = ranks.join(queries.select("cid").distinct(), "cid")
    cells = F.sequence(F.floor(F.greatest(F.col("rank") - reach, F.lit(0)) / cell_rows), F.floor(F.least(F.col("rank") + reach, F.lit(total - 1)) / cell_rows))
    asking = asking.withColumn("cell", F.explode(cells)).select("curve", "cell", F.col("cid").alias("query"), F.lit(True).alias("asks"))
    holding = ranks.select("curve", F.floor(F.col("rank") / cell_rows).alias("cell"), "cid")
    places = asking.select("curve", "cell", F.col("query").alias("cid"), "asks").unionByName(holding.withColumn("asks", F.lit(False)))
    rows = places.join(classes.select("cid", "vec", F.col("ids")[0].alias("first")), "cid")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy()
        points = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
        held, ask = points[~asks], points[asks]
        cid, first, query = pdf["cid"].to_numpy()[~asks], pdf["first"].to_numpy()[~asks], pdf["cid"].to_numpy()[asks]
        out = []
        for q, point in zip(query, ask):
            diff = held - point
            score = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            best = np.lexsort((first, score))[: k + 1]
            out.append(pd.DataFrame({"query": q, "cid": cid[best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "cid": [], "score": []}).astype({"query": "int64", "cid": "int64"})

    found = rows.groupBy("curve", "cell").applyInPandas(compare, "query long, cid long, score double")
    found = found.groupBy("query", "cid").agg(F.min("score").alias("score")).join(classes.select("cid", "ids"), "cid")
    best = F.slice(F.sort_array(F.collect_list(F.struct("score", F.col("ids")[0].alias("first"), "ids"))), 1, k + 1)
    lists = found.groupBy("query").agg(best.alias("best"))  # at most (k + 1) rows for each curve and cell
    one = lists.select(F.col("query").alias("cid"), F.explode("best").alias("b")).select("cid", "b.score", F.explode("b.ids").alias(id_col))
    answers = queries.join(one, "cid").filter(F.col("query_id") != F.col(id_col))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", id_col))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
