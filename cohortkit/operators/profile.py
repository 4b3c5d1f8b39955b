"""Single-pass table profiling in long form ``(dataset, column, metric, value)``.

The reference profiles with one action per metric; here each profile is one
aggregate (one scan, partial aggregation on the map side) that is unpivoted
afterwards, so nothing but the final rows reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DATASET_ROW = "_dataset"


def _long(agg_row: DataFrame, dataset: str, entries: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot a one-row aggregate; ``entries`` = (alias, column, metric)."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(col).alias("column"), F.lit(metric).alias("metric"),
                 F.col(alias).cast("string").alias("value"))
        for alias, col, metric in entries
    ])).alias("m")
    return agg_row.select(stacked).select(
        F.lit(dataset).alias("dataset"), "m.column", "m.metric", "m.value")


def profile(df: DataFrame, dataset: str, distinct_cols: Sequence[str] = (),
            blank_is_null: bool = False, approx_distinct: bool = False) -> DataFrame:
    """Row count, null count of every column and distinct count of ``distinct_cols``.

    * null counts treat an empty string as null when ``blank_is_null``;
    * distinct counts count NULL as one value (like ``select(c).distinct().count()``);
      ``approx_distinct`` switches to HyperLogLog for very wide or huge tables.
    """
    aggs, entries = [F.count(F.lit(1)).alias("__rows")], [("__rows", DATASET_ROW, "row_count")]
    metric = "null_or_blank_count" if blank_is_null else "null_count"
    for i, c in enumerate(df.columns):
        cond = F.col(c).isNull()
        if blank_is_null and dict(df.dtypes)[c] == "string":
            cond = cond | (F.col(c) == "")
        aggs.append(F.count_if(cond).alias(f"__n{i}"))
        entries.append((f"__n{i}", c, metric))
    for i, c in enumerate(distinct_cols):
        distinct = F.approx_count_distinct(c) if approx_distinct else F.count_distinct(c)
        has_null = F.max(F.when(F.col(c).isNull(), 1).otherwise(0))
        aggs.append((distinct + has_null).alias(f"__d{i}"))
        entries.append((f"__d{i}", c, "distinct_count"))
    return _long(df.agg(*aggs), dataset, entries)


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_count, row_count, null_pct)``, one aggregate."""
    from cohortkit.functions.numeric import pct

    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("null_count"))
        for i, c in enumerate(cols)])).alias("m")
    return (row.select("rows", stacked)
            .select("m.column", "m.null_count", F.col("rows").alias("row_count"))
            .withColumn("null_pct", pct("null_count", "row_count")))


def top_values(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """Top-``k`` value counts of several columns in one scan.

    Output ``(column, value, n, rank)``; NULL is a value of its own; ties on
    ``n`` are broken by the value (NULL first) so the result is deterministic.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("p")
    counts = df.select(pairs).select("p.column", "p.value").groupBy("column", "value").count()
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return (counts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("column", "value", F.col("count").alias("n"), "rank"))


def numeric_summary(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """count / mean / stddev / min / max per numeric column, long form.

    Columns are cast to double first, so min/max are numeric (the
    reference's ``describe()`` on string columns gave lexicographic ones).
    Mean and stddev are rounded to ``digits`` places.
    """
    aggs, entries = [], []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"__c{i}"),
                 F.round(F.avg(x), digits).alias(f"__a{i}"),
                 F.round(F.stddev_samp(x), digits).alias(f"__s{i}"),
                 F.min(x).alias(f"__mi{i}"), F.max(x).alias(f"__ma{i}")]
        entries += [(f"__c{i}", c, "count"), (f"__a{i}", c, "mean"), (f"__s{i}", c, "stddev"),
                    (f"__mi{i}", c, "min"), (f"__ma{i}", c, "max")]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(m).alias("metric"), F.col(a).alias("value"))
        for a, c, m in entries])).alias("m")
    return df.agg(*aggs).select(stacked).select("m.column", "m.metric", "m.value")


def schema_rows(df: DataFrame, dataset: str) -> DataFrame:
    """``(dataset, column, data_type, position, non_null)`` for every column.

    Types come from the schema; the non-null counts come from one aggregate
    over the data, so the listing also says which columns are populated.
    """
    types = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                               F.lit(t).alias("data_type"), F.col(f"__nn{i}").alias("non_null"))
                      for i, (c, t) in enumerate(df.dtypes)])
    row = df.agg(*[F.count(F.col(c)).alias(f"__nn{i}") for i, c in enumerate(df.columns)])
    return (row.select(F.explode(types).alias("t"))
            .select(F.lit(dataset).alias("dataset"), "t.column", "t.data_type", "t.position",
                    "t.non_null"))


def table_profile(df: DataFrame, dataset: str, categoricals: Sequence[str] = (), numerics: Sequence[str] = (),
                  k: int = 10, digits: int = 2, blank_is_null: bool = False) -> DataFrame:
    """The whole profile as ``(dataset, column, metric, value)`` text rows.

    Row count; null count of every column; distinct count and the ``k`` most
    frequent values of each categorical (``top_<rank>_value`` and
    ``top_<rank>_count``); count, mean, stddev, min and max of each numeric,
    fixed at ``digits`` places.
    """
    parts = [profile(df, dataset, categoricals, blank_is_null)]
    if categoricals:
        top = top_values(df, categoricals, k)
        entries = F.explode(F.array(
            F.struct(F.format_string("top_%d_value", "rank").alias("metric"), F.col("value")),
            F.struct(F.format_string("top_%d_count", "rank").alias("metric"), F.col("n").cast("string").alias("value")))).alias("m")
        parts.append(top.select("column", entries).select(F.lit(dataset).alias("dataset"), "column", "m.metric", "m.value"))
    if numerics:
        text = F.when(F.col("metric") == "count", F.col("value").cast("bigint").cast("string")).otherwise(
            F.format_string(f"%.{digits}f", "value"))
        text = F.when(F.col("value").isNotNull(), text)
        numbers = numeric_summary(df, numerics, digits + 6)
        parts.append(numbers.select(F.lit(dataset).alias("dataset"), "column", "metric", text.alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows (of each group ``by``) with the smallest SHA-256 of ``seed:key``.

    A uniform sample without replacement if ``key`` identifies rows.  It does not
    depend on partitioning, any SQL engine can repeat it, and the samples of two
    parts merge into the sample of both (the ``n`` smallest of the union).  Each
    task keeps ``n`` rows (of a group) before anything is shuffled.  Rows with
    one key come together, in no defined order; a NULL key is hashed as no text.
    """
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    if not by:
        return df.orderBy(order).limit(n)
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("__place", F.row_number().over(w)).filter(F.col("__place") <= n).drop("__place")
