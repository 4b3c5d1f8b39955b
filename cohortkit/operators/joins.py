"""Join helpers.  No join is forced: Spark's size estimate and AQE's measured sizes decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine_scalars(*rows: DataFrame) -> DataFrame:
    """Merge one-row aggregates with distinct column names into one row.

    A union plus one global aggregate: no join, no cross product.
    """
    merged = rows[0]
    for r in rows[1:]:
        merged = merged.unionByName(r, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def per_key(df: DataFrame, key: str, *aggs: Column) -> DataFrame:
    """One row per ``key`` (with ``aggs``), laid out so that a join on ``key`` can still be split.

    An aggregate leaves its rows partitioned by the grouping columns.  A
    join on the same key would reuse that layout, and AQE cannot split the
    hot partitions of such a join.  Grouping by the key and its hash as well
    gives the same rows in another layout, so the join gets an exchange of
    its own on both sides: a second shuffle of the (small) key table, in
    return for which AQE's skew handling splits a hot key of the other side
    over many tasks, whatever columns that side has.
    """
    h = F.xxhash64(key).alias("__layout")
    grouped = df.groupBy(F.col(key), h)
    out = grouped.agg(*aggs) if aggs else df.select(F.col(key), h).distinct()
    return out.drop("__layout")
