import datetime as dt

from cohortkit.operators import series
from tests.conftest import rows


def test_decode_known_and_unknown_codes(spark):
    raw = spark.createDataFrame([("JTS510000000000000LDR", "2023", "M07", " 1.1 "),
                                 ("JTS000000000000000QUR", "2023", "M13", "x")],
                                "series_id string, year string, period string, value string")
    got = rows(series.decode(raw), "obs_date", "year", "month", "industry", "metric", "value")
    assert got[0] == (dt.date(2023, 7, 1), 2023, 7, "Information", "layoffs_discharges_rate", 1.1)
    assert got[1] == (None, 2023, 13, "Total Nonfarm", "QU", None)


def _series(spark, vals, metric="m", industry="I"):
    return spark.createDataFrame(
        [(dt.date(y, mth, 1), y, mth, industry, metric, v) for (y, mth, v) in vals],
        "obs_date date, year int, month int, industry string, metric string, value double")


def test_pivot_missing_cell_is_null(spark):
    a = _series(spark, [(2020, 1, 1.0), (2020, 2, 2.0)], metric="a")
    b = _series(spark, [(2020, 1, 5.0)], metric="b")
    got = rows(series.pivot_metrics(a.unionByName(b), ["a", "b"]), "month", "a", "b")
    assert got == [(1, 1.0, 5.0), (2, 2.0, None)]


def test_window_stats_and_drop(spark):
    s = _series(spark, [(2022, 1, 8.3), (2022, 2, 7.0), (2023, 1, 4.3), (2023, 2, 4.4), (2024, 1, 4.0)])
    w = rows(series.window_stats(s, "2023-01-01", "2024-12-31", 2022),
             "median_all", "window_median", "window_min", "window_max", "peak_value", "peak_date")
    assert w == [(4.4, 4.3, 4.0, 4.4, 8.3, dt.date(2022, 1, 1))]
    d = rows(series.peak_drop(s, 2022, "2023-01-01", "2024-12-31"), "drop_pct", "period_change_pct")
    # (8.3 - 4.3) / 8.3 = 48.19 %; window average 12.7/3 vs peak-year average 7.65 -> -44.66 %
    assert d == [(48.19, -44.66)]


def test_completeness_and_crosscheck(spark):
    s = _series(spark, [(2020, 1, 1.0), (2020, 3, 1.0)], metric="a").unionByName(
        _series(spark, [(2020, 1, 0.5), (2020, 3, 2.0)], metric="b"))
    c = rows(series.completeness(s).orderBy("metric"), "months", "expected_months", "complete")
    assert c == [(2, 3, False), (2, 3, False)]
    x = rows(series.crosscheck(s, "a", "b"), "periods", "always_above", "exceptions")
    assert x == [(2, False, 1)]


def test_annual_average_exact(spark):
    s = _series(spark, [(2020, m, v) for m, v in [(1, 0.1), (2, 0.1), (3, 0.1), (4, 0.2)]])
    # mean 0.125 -> 0.13 (half-up on the exact value)
    assert rows(series.annual_average(s), "avg_value", "months") == [(0.13, 4)]
