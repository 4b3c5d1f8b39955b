"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hook each vertex' neighbours (larger ones, or smaller ones and itself) to the smallest vertex around it.

    The minimum is a map-side aggregate, so a vertex on very many edges is one
    row a task; the join back to the edges can be split by adaptive execution.
    """
    if small:
        directed = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    else:
        directed = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select(F.col("b"), F.col("a")))
    lowest = directed.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
    joined = directed.join(lowest, "v")
    hooked = joined.select("u", "m") if small else joined.filter(F.col("u") > F.col("v")).select("u", "m")
    if small:
        hooked = hooked.union(lowest.select(F.col("v"), F.col("m")))
    return hooked.filter(F.col("u") != F.col("m")).select(F.col("u").alias("b"), F.col("m").alias("a")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``v, root`` of every vertex on an edge ``a, b`` that is not its component's smallest vertex.

    Rounds are written to the shared folder; they end when the edges no longer change.
    """
    edges = edges.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, name), None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            out = edges.select(F.col("b").alias("v"), F.col("a").alias("root"))
            out.scratch_path = edges.scratch_path
            return out
        before, old = mark, edges
        edges = materialize(_star(_star(edges, small=False), small=True), name)
        release(old)
