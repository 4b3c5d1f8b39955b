import datetime as dt


from pyspark.sql import functions as F

from cohortkit.functions import clean
from cohortkit.functions.numeric import pct, round_half_up_ratio
from cohortkit.operators import keys
from tests.conftest import rows


def one_col(spark, values, name="c", typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {typ}").orderBy("i")


def test_split_location(spark):
    df = one_col(spark, ["Princeton, NJ", "United States", "a,b,c", None])
    out = df.select(clean.split_part("c", 0).alias("city"), clean.split_part("c", 1).alias("state"))
    assert rows(out) == [("princeton", "nj"), ("united states", None), ("a", "b"), (None, None)]


def test_flag_coercion(spark):
    df = one_col(spark, ["1", "1.0", "0", "", None])
    assert [r[0] for r in rows(df.select(clean.to_flag("c")))] == [True, True, False, False, False]
    assert [r[0] for r in rows(df.select(clean.to_nullable_flag("c")))] == [True, True, False, None, None]


def test_canonical_key_quirks(spark):
    df = one_col(spark, ["Glastender, Inc.", "Zinc", "Acme Corporation. ", "Foo Inc. LLC", "X Corp", None])
    got = [r[0] for r in rows(df.select(clean.canonical_key("c")))]
    assert got == ["glastender,", "z", "acme corporation.", "foo inc.", "x", None]


def test_reference_alias_map(spark):
    df = one_col(spark, ["x", "x corp", "amazon", None], name="k")
    out = keys.apply_aliases(df, "k", keys.REFERENCE_ALIASES)
    assert [r[0] for r in rows(out, "k")] == ["twitter", "twitter", "amazon", None]


def test_alias_table_conflict_resolves_to_smallest(spark):
    facts = one_col(spark, ["a", "b", None], name="k")
    table = spark.createDataFrame([("a", "z"), ("a", "y"), ("c", "q")], "alias string, canonical string")
    out = keys.apply_alias_table(facts, "k", table, out="r")
    assert sorted(rows(out, "k", "r"), key=str) == sorted([("a", "y"), ("b", "b"), (None, None)], key=str)


def test_epoch_millis(spark):
    df = one_col(spark, ["1713397508000.0", "", None])
    assert [r[0] for r in rows(df.select(clean.epoch_millis_to_date("c")))] == [dt.date(2024, 4, 17), None, None]


def test_lenient_date(spark):
    df = one_col(spark, ["4/16/2026", "4/31/2026", "", None])
    assert [r[0] for r in rows(df.select(clean.parse_date("c")))] == [dt.date(2026, 4, 16), None, None, None]


def test_lenient_int_and_double(spark):
    df = one_col(spark, ["120", "120.0", "x", ""])
    assert [r[0] for r in rows(df.select(clean.to_int("c")))] == [120, 120, None, None]
    assert [r[0] for r in rows(df.select(clean.to_double("c")))] == [120.0, 120.0, None, None]


def test_first_of_month_guards_bad_months(spark):
    df = spark.createDataFrame([(2023, 7), (2023, 13), (None, 1)], "y int, m int")
    assert [r[0] for r in rows(df.select(clean.first_of_month("y", "m")))] == [dt.date(2023, 7, 1), None, None]


def test_pct_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(201, 20000), (1, 3), (0, 0)], "n bigint, t bigint")
    assert [r[0] for r in rows(df.select(pct("n", "t")))] == [1.01, 33.33, None]
    assert [r[0] for r in rows(df.select(round_half_up_ratio("n", "t", 4)))] == [0.0101, 0.3333, None]


def test_lookup_label_passes_unknown_through(spark):
    df = one_col(spark, ["JO", "QU", None])
    got = [r[0] for r in rows(df.select(clean.lookup_label("c", {"JO": "job_openings_rate"})))]
    assert got == ["job_openings_rate", "QU", None]


def test_epoch_functions_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(dt.datetime(2024, 4, 17, 23, 45, 8, 123456),)], "ts timestamp_ntz")
        got = rows(df.select(clean.ntz_epoch_millis("ts").alias("m"),
                             clean.epoch_millis_to_date(F.lit("1713397508000.0")).alias("d")))
        assert got == [(1713397508123, dt.date(2024, 4, 17))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
