"""Coded monthly series: decode, filter, select, pivot and window figures.

Series rows arrive as ``(series_id, year, period, value)`` text, where the
fixed-width id packs an industry code and a data-element code.  Decoding is
pure projection; figures over date windows are conditional aggregates, so
the whole chain stays one lazy plan (no single-process step at the end).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.clean import first_of_month, lookup_label
from cohortkit.functions.numeric import round_half_up_ratio

# --- fixed values (layout and codes of the reference's series ids) ---------
ANNUAL_AVERAGE_PERIOD = "M13"
INDUSTRY_CODE_POS, INDUSTRY_CODE_LEN = 4, 6      # 1-based, e.g. JTS|000000|...
ELEMENT_POS, ELEMENT_LEN = 19, 2                  # data element, e.g. ...|JO|R
REFERENCE_SERIES_IDS = [
    "JTS000000000000000JOR",
    "JTS000000000000000HIR",
    "JTS000000000000000LDR",
    "JTS510000000000000JOR",
    "JTS510000000000000HIR",
    "JTS510000000000000LDR",
]
METRIC_BY_ELEMENT = {
    "JO": "job_openings_rate",
    "HI": "hires_rate",
    "LD": "layoffs_discharges_rate",
}
INDUSTRY_BY_CODE = {
    "000000": "Total Nonfarm",
    "510000": "Information",
}
# ---------------------------------------------------------------------------


def decode(raw: DataFrame, industries: Mapping[str, str] = INDUSTRY_BY_CODE,
           metrics: Mapping[str, str] = METRIC_BY_ELEMENT, keep_id: bool = False) -> DataFrame:
    """``(series_id, year, period, value)`` text to ``(obs_date, year, month, industry, metric, value)``.

    Unknown industry or element codes pass through unchanged; a period
    outside M01..M12 gives a NULL ``obs_date``; junk numbers give NULL.
    """
    sid = F.trim(F.col("series_id"))
    year = F.trim(F.col("year")).try_cast("int")
    period = F.trim(F.col("period"))
    month = F.substring(period, 2, 2).try_cast("int")
    cols = [first_of_month(year, month).alias("obs_date"), year.alias("year"), month.alias("month"),
            lookup_label(F.substring(sid, INDUSTRY_CODE_POS, INDUSTRY_CODE_LEN), industries).alias("industry"),
            lookup_label(F.substring(sid, ELEMENT_POS, ELEMENT_LEN), metrics).alias("metric"),
            F.trim(F.col("value")).try_cast("double").alias("value")]
    if keep_id:
        cols = [sid.alias("series_id")] + cols
    return raw.select(*cols)


def series_rules(keep_ids: Sequence[str] = REFERENCE_SERIES_IDS):
    """The reference's two ordered drop rules: non-target series, then the M13 period."""
    from cohortkit.operators.rules import Rule, equals, not_in

    return [Rule("non_target_series", not_in("series_id", keep_ids)),
            Rule("period_m13", equals("period", ANNUAL_AVERAGE_PERIOD))]


def select_metric(series: DataFrame, metric: str, out: str | None = None) -> DataFrame:
    """One metric with its value renamed, ordered by industry and date."""
    return (series.filter(F.col("metric") == metric)
            .select("obs_date", "year", "month", "industry", F.col("value").alias(out or metric))
            .orderBy("industry", "obs_date"))


def pivot_metrics(series: DataFrame, metrics: Sequence[str],
                  keys: Sequence[str] = ("obs_date", "year", "month", "industry")) -> DataFrame:
    """Metrics side by side (max per cell); a missing cell is NULL."""
    return (series.filter(F.col("metric").isin(list(metrics)))
            .groupBy(*keys).pivot("metric", list(metrics)).agg(F.max("value"))
            .orderBy("industry", "obs_date"))


def in_window(date_col: str, start: str, end: str) -> Column:
    return F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def window_stats(series: DataFrame, start: str, end: str, peak_year: int,
                 keys: Sequence[str] = ("industry", "metric"), digits: int = 4) -> DataFrame:
    """Per series: overall and window median (interpolated), window min/max, peak in a year and its date."""
    v = F.col("value")
    inside = in_window("obs_date", start, end)
    in_year = F.col("year") == F.lit(peak_year)
    return series.groupBy(*keys).agg(
        F.round(F.median(v), digits).alias("median_all"),
        F.round(F.median(F.when(inside, v)), digits).alias("window_median"),
        F.min(F.when(inside, v)).alias("window_min"),
        F.max(F.when(inside, v)).alias("window_max"),
        F.max(F.when(in_year, v)).alias("peak_value"),
        # earliest month holding the peak (struct order makes ties deterministic)
        F.min_by(F.col("obs_date"), F.when(in_year, F.struct(-v, F.col("obs_date")))).alias("peak_date"),
    )


def peak_drop(series: DataFrame, peak_year: int, start: str, end: str,
              keys: Sequence[str] = ("industry", "metric")) -> DataFrame:
    """Peak-to-window-median drop and change between two period averages, in %.

    Averages are computed from exact tenths (values carry one decimal), so
    the result does not depend on summation order.
    """
    v = F.col("value")
    tenths = F.round(v * 10).cast("bigint")
    inside = in_window("obs_date", start, end)
    in_year = F.col("year") == F.lit(peak_year)
    agg = series.groupBy(*keys).agg(
        F.max(F.when(in_year, v)).alias("peak_value"),
        F.median(F.when(inside, v)).alias("window_median"),
        F.sum(F.when(in_year, tenths)).alias("__a_sum"), F.count(F.when(in_year, v)).alias("__a_n"),
        F.sum(F.when(inside, tenths)).alias("__b_sum"), F.count(F.when(inside, v)).alias("__b_n"))
    drop = F.round(F.try_divide(F.lit(100.0) * (F.col("peak_value") - F.col("window_median")),
                                F.col("peak_value")), 2)
    # change of the window average against the peak-year average, exact rational
    num = F.col("__b_sum") * F.col("__a_n") - F.col("__a_sum") * F.col("__b_n")
    den = F.col("__a_sum") * F.col("__b_n")
    return (agg.withColumn("drop_pct", drop)
            .withColumn("period_change_pct", round_half_up_ratio(num, den, 2, factor=100))
            .withColumn("window_median", F.round("window_median", 4))
            .drop("__a_sum", "__a_n", "__b_sum", "__b_n"))


def annual_average(series: DataFrame, keys: Sequence[str] = ("industry", "metric")) -> DataFrame:
    """Average value per year, exact to two places (half-up on the rational mean)."""
    tenths = F.round(F.col("value") * 10).cast("bigint")
    return (series.filter(F.col("value").isNotNull())
            .groupBy(*keys, "year").agg(F.sum(tenths).alias("__s"), F.count(F.lit(1)).alias("months"))
            .withColumn("avg_value", round_half_up_ratio(F.col("__s"), F.col("months") * 10, 2))
            .drop("__s"))


def crosscheck(series: DataFrame, above: str, below: str, keys: Sequence[str] = ("industry",)) -> DataFrame:
    """Per group: is ``above`` > ``below`` in every period, and how many periods fail."""
    wide = pivot_metrics(series, [above, below], keys=("obs_date",) + tuple(keys))
    ok = F.col(above) > F.col(below)
    return wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("periods"),
        F.coalesce(F.bool_and(ok), F.lit(False)).alias("always_above"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("exceptions"))


def completeness(series: DataFrame, keys: Sequence[str] = ("industry", "metric")) -> DataFrame:
    """Rows, distinct months, first/last month and whether every month in between is present."""
    agg = series.filter(F.col("obs_date").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("obs_date").alias("months"),
        F.min("obs_date").alias("first_month"), F.max("obs_date").alias("last_month"))
    expected = (F.months_between("last_month", "first_month").cast("int") + 1)
    return (agg.withColumn("expected_months", expected)
            .withColumn("complete", (F.col("months") == F.col("expected_months"))
                        & (F.col("rows") == F.col("expected_months"))))


def missing_months(series: DataFrame, keys: Sequence[str] = ("industry", "metric"), first: str | None = None, last: str | None = None) -> DataFrame:
    """``(keys, missing_month)``: the months of each series' calendar without an observation.

    The calendar runs from the series' first month to its last, or over the
    given range (``yyyy-mm-dd``) for all series; a series with dates outside
    the range is still only asked for the range.  Undated rows take no part.
    """
    dated = series.filter(F.col("obs_date").isNotNull()).select(*keys, F.trunc("obs_date", "month").alias("__m")).distinct()
    ends = dated.groupBy(*keys).agg(F.min("__m").alias("lo"), F.max("__m").alias("hi"))
    lo, hi = (F.trunc(F.lit(x).cast("date"), "month") if x else F.col(c) for x, c in ((first, "lo"), (last, "hi")))
    months = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).otherwise(F.expr("CAST(array() AS ARRAY<DATE>)"))
    calendar = ends.select(*keys, F.explode(months).alias("missing_month"))
    seen = dated.select(*[F.col(k).alias(f"__{k}") for k in keys], "__m")
    same = F.col("missing_month") == F.col("__m")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return calendar.join(seen, same, "left_anti")


def composite(series: DataFrame, weights: DataFrame, weight_col: str = "weight",
              keys: Sequence[str] = ("obs_date", "metric")) -> DataFrame:
    """Weighted average across industries per date and metric: ``sum(w*v)/sum(w)``.

    ``weights`` is ``(industry, weight)`` with integral weights; the mean is
    exact (tenths arithmetic) and rounded half-up to two places.
    """
    tenths = F.round(F.col("value") * 10).cast("bigint")
    j = series.filter(F.col("value").isNotNull()).join(weights, "industry", "inner")
    return (j.groupBy(*keys).agg(F.sum(tenths * F.col(weight_col)).alias("__wv"),
                                 F.sum(weight_col).alias("total_weight"),
                                 F.count(F.lit(1)).alias("industries"))
            .withColumn("weighted_value", round_half_up_ratio(F.col("__wv"), F.col("total_weight") * 10, 2))
            .drop("__wv"))
