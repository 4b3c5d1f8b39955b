"""Cohort measures: counts, shares, rates, medians, top-k, matrices, contrasts.

Every function aggregates first (partial aggregation on the map side, so a
hot cohort or category costs no more than a cold one) and only then applies
windows, which therefore run over small count tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.numeric import pct


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_totals(counts: DataFrame, group: str | Sequence[str], n: str = "n", out: str = "total") -> DataFrame:
    """Attach the per-group sum of ``n`` to every count row.

    The totals are an aggregate and Spark picks the join from its measured
    size, so the counts table is never gathered into one task per cohort as
    a window over the whole cohort would do.
    """
    keys = [group] if isinstance(group, str) else list(group)
    totals = counts.groupBy(*keys).agg(F.sum(n).cast("bigint").alias(out))
    return counts.join(totals, keys)


def _rows(weight: str | None, cond: Column | None = None) -> Column:
    """Number of rows (that fit ``cond``): counted, or the sum of a pre-aggregated count column."""
    if weight is None:
        return F.count(F.lit(1)) if cond is None else F.count_if(cond)
    n = F.col(weight) if cond is None else F.when(cond, F.col(weight)).otherwise(F.lit(0))
    return F.sum(n).cast("bigint")


def category_share(df: DataFrame, cohort: str, category: str, out_category: str | None = None,
                   keep: Column | None = None, weight: str | None = None) -> DataFrame:
    """``(cohort, category, n, pct_of_cohort)``; ``weight`` sums a pre-aggregated count column."""
    src = df.filter(keep) if keep is not None else df
    counts = src.groupBy(cohort, F.col(category).alias(out_category or category)).agg(_rows(weight).alias("n"))
    return (with_totals(counts, cohort, out="__total")
            .withColumn("pct_of_cohort", pct("n", "__total")).drop("__total"))


def top_k(df: DataFrame, cohort: str, category: str, k: int = 10, out_category: str | None = None,
          keep: Column | None = None, weight: str | None = None) -> DataFrame:
    """Top-``k`` categories per cohort with their share of the cohort total.

    ``weight`` sums a pre-aggregated count column instead of counting rows.
    Ties on ``n`` are broken by the category, ascending.  Catalyst turns the
    ``row_number() <= k`` filter into a WindowGroupLimit.
    """
    name = out_category or category
    src = df.filter(keep) if keep is not None else df
    n = _rows(weight)
    counts = src.groupBy(cohort, F.col(category).alias(name)).agg(n.alias("n"))
    w_rank = Window.partitionBy(cohort).orderBy(F.desc("n"), F.asc(name))
    # rank first (WindowGroupLimit keeps k rows per cohort and map task), then
    # attach the cohort totals computed by aggregation
    top = counts.withColumn("rank", F.row_number().over(w_rank)).filter(F.col("rank") <= k)
    totals = counts.groupBy(cohort).agg(F.sum("n").cast("bigint").alias("__total"))
    return (top.join(totals, cohort)
            .withColumn("pct_of_cohort", pct("n", "__total")).drop("__total"))


def flag_rate(df: DataFrame, cohort: str, flag: Column, prefix: str = "flag", weight: str | None = None) -> DataFrame:
    """``(cohort, total, <prefix>_n, <prefix>_pct)``: conditional count over all rows."""
    return (df.groupBy(cohort).agg(_rows(weight).alias("total"),
                                   _rows(weight, F.coalesce(flag, F.lit(False))).alias(f"{prefix}_n"))
            .withColumn(f"{prefix}_pct", pct(f"{prefix}_n", "total")))


def set_rate(df: DataFrame, cohort: str, code: str, code_set: Sequence[str], prefix: str = "set") -> DataFrame:
    """Share of rows whose ``code`` is in ``code_set``; also the complement count."""
    inside = F.col(code).isin(list(code_set))
    return (df.groupBy(cohort).agg(F.count(F.lit(1)).alias("total"),
                                   F.count_if(F.coalesce(inside, F.lit(False))).alias(f"{prefix}_n"))
            .withColumn("other_n", F.col("total") - F.col(f"{prefix}_n"))
            .withColumn(f"{prefix}_pct", pct(f"{prefix}_n", "total")))


def null_aware_rate(df: DataFrame, cohort: str, flag: Column, prefix: str = "flag",
                    weight: str | None = None) -> DataFrame:
    """Rate among known values (unknown excluded from the denominator) next to the plain rate."""
    return (df.groupBy(cohort).agg(_rows(weight).alias("total"), _rows(weight, flag.isNotNull()).alias("known"),
                                   _rows(weight, F.coalesce(flag, F.lit(False))).alias(f"{prefix}_n"))
            .withColumn(f"{prefix}_pct_known", pct(f"{prefix}_n", "known"))
            .withColumn(f"{prefix}_pct_all", pct(f"{prefix}_n", "total")))


def group_median(df: DataFrame, keys: Sequence[str], value: str, exact: bool = False,
                 accuracy: int = 10000, out: str = "median", count_col: str = "n") -> DataFrame:
    """Median and row count per group.

    ``exact=False`` is ``percentile_approx`` (a real element, mergeable
    sketch of bounded size; ``accuracy`` trades memory for rank error).
    ``exact=True`` is the interpolated median of an integral column (scale
    money to cents first), found by radix selection so that no group is
    ever merged in one task (see ``quantiles.exact_median``).
    """
    x = F.col(value)
    if exact:
        from cohortkit.operators.quantiles import exact_median

        return exact_median(df, keys, value, out=out, count_col=count_col)
    med = F.percentile_approx(x, 0.5, accuracy)
    return df.filter(x.isNotNull()).groupBy(*keys).agg(med.alias(out), F.count(F.lit(1)).alias(count_col))


def ordinal_rank(col: Column | str, order: Sequence[str]) -> Column:
    """1-based position of the value in a fixed category order (0 when absent)."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), _c(col)).cast("int")


def cumulative_share(counts: DataFrame, cohort: str, order_col: str, ascending: bool = True,
                     out: str = "cum_pct", totals: DataFrame | None = None) -> DataFrame:
    """Running share of ``n`` within each cohort in ``order_col`` order.

    Computed from running counts (not from summed rounded percentages).
    ``counts`` should be short per cohort (ordinal levels, or a top-k
    result); pass ``totals`` ``(cohort, total)`` when ``counts`` holds only
    the top rows of a longer list.
    """
    o = F.asc(order_col) if ascending else F.desc(order_col)
    w = Window.partitionBy(cohort).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if totals is None:
        totals = counts.groupBy(cohort).agg(F.sum("n").cast("bigint").alias("total"))
    return (counts.withColumn("cum_n", F.sum("n").over(w).cast("bigint"))
            .join(totals.select(cohort, F.col("total").alias("__total")), cohort)
            .withColumn(out, pct("cum_n", "__total")).drop("__total"))


def pivot_cohorts(df: DataFrame, index: Sequence[str], cohort: str, values: Mapping[str, Column],
                  cohorts: Sequence[str]) -> DataFrame:
    """Wide table: one column per (value, cohort), named ``<value>_<cohort>``.

    The cohort list is explicit, so Spark needs no discovery job.
    """
    aggs = [v.alias(name) for name, v in values.items()]
    wide = df.groupBy(*index).pivot(cohort, list(cohorts)).agg(*aggs)
    if len(aggs) == 1:  # Spark names single-aggregate pivot columns by the cohort only
        only = next(iter(values))
        for c in cohorts:
            wide = wide.withColumnRenamed(c, f"{only}_{c}")
    else:
        for c in cohorts:
            for name in values:
                wide = wide.withColumnRenamed(f"{c}_{name}", f"{name}_{c}")
    return wide


def contrast(a: Column, b: Column, digits: int = 2) -> tuple[Column, Column]:
    """(difference, ratio) of two measures, rounded; zero-safe ratio."""
    return F.round(a - b, digits), F.round(F.try_divide(a, b), 3)


def small_cells(counts: DataFrame, min_n: int, value_cols: Sequence[str]) -> DataFrame:
    """Flag cells with ``n < min_n`` and suppress their ``value_cols`` (set NULL)."""
    out = counts.withColumn("small_cell", F.col("n") < F.lit(min_n))
    for c in value_cols:
        out = out.withColumn(c, F.when(~F.col("small_cell"), F.col(c)))
    return out
