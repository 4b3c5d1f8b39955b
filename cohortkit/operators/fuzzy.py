"""Fuzzy key matching: all pairs within a Levenshtein distance, without a cross join.

Candidates come from *symmetric deletion* blocking: every key is expanded
into the strings obtained by deleting up to ``d`` characters (itself
included).  If ``ed(a, b) <= d`` then some deletion variant of ``a`` equals
some deletion variant of ``b``, so an equi-join on the variants finds every
true pair.  A join block (one variant) only holds keys within ``2d`` edits
of each other, so block sizes follow the size of the answer rather than of
the input, and there is no cap on partners.  Candidates are verified with
the built-in ``levenshtein(l, r, threshold)``.

A key has about as many variants as characters, but Spark estimates the
expanded side at the size of its input and would broadcast it.  So the join
on variants names its strategy: both sides are shuffled and merged, and
adaptive execution may split a crowded partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deletion_variants(keys: DataFrame, max_dist: int) -> DataFrame:
    """``(s, v)``: every string ``v`` reachable from ``s`` by at most ``max_dist`` deletions.

    Each pass explodes positions ``0..len`` of the current variants, where 0
    keeps the variant and ``i`` deletes its i-th character, so the input is
    read once and no union is needed.
    """
    out = keys.select("s", F.col("s").alias("v"))
    for _ in range(max_dist):
        i = F.col("i")
        cut = F.concat(F.substring("v", 1, i - 1), F.substring("v", i + 1, 1 << 30))
        out = (out.select("s", "v", F.explode(F.sequence(F.lit(0), F.length("v"))).alias("i"))
               .select("s", F.when(i == 0, F.col("v")).otherwise(cut).alias("v"))
               .distinct())
    return out


def fuzzy_pairs(left: DataFrame, left_col: str, right: DataFrame, right_col: str, max_dist: int = 1,
                include_equal: bool = False) -> DataFrame:
    """``(left_key, right_key, distance)`` for distinct non-null keys with distance <= ``max_dist``."""
    lk = left.select(F.col(left_col).alias("s")).filter(F.col("s").isNotNull()).distinct()
    rk = right.select(F.col(right_col).alias("s")).filter(F.col("s").isNotNull()).distinct()
    lv = deletion_variants(lk, max_dist).withColumnRenamed("s", "left_key")
    rv = deletion_variants(rk, max_dist).withColumnRenamed("s", "right_key")
    cands = lv.join(rv.hint("merge"), "v").select("left_key", "right_key").distinct()
    out = (cands.withColumn("distance", F.levenshtein("left_key", "right_key", max_dist))
           .filter(F.col("distance") >= 0))
    if not include_equal:
        out = out.filter(F.col("left_key") != F.col("right_key"))
    return out.select("left_key", "right_key", "distance")
