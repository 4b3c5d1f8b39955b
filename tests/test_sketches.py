"""Summaries that are stored and merged, against exact answers."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from cohortkit.operators import cohort, profile, series, sketches
from cohortkit.operators.joins import per_key
from tests.conftest import plan_text, rows


def test_distinct_sketches_merge_to_the_same_estimate(spark):
    df = spark.range(30000).select((F.col("id") % 9000).alias("many"), F.when(F.col("id") % 3 == 0, (F.col("id") % 7).cast("string")).alias("few"),
                                   F.lit(None).cast("date").alias("none"), F.floor(F.col("id") / 5000).alias("day"))
    stored = sketches.distinct_sketches(df, ["many", "few", "none"], ["day"])
    whole = dict(rows(sketches.estimate_distinct(sketches.merge_distinct(stored)), "column", "estimate"))
    halves = sketches.merge_distinct(stored.withColumn("half", F.col("day") < 2), ["half"])
    assert dict(rows(sketches.estimate_distinct(sketches.merge_distinct(halves)), "column", "estimate")) == whole
    exact = dict(rows(sketches.distinct_exact(df, ["many", "few", "none"]), "column", "exact"))
    assert exact == {"many": 9000, "few": 8, "none": 1} and whole["few"] == 8 and whole["none"] == 1
    assert abs(whole["many"] - 9000) <= 4 * sketches.HLL_ERROR * 9000


def test_exact_distinct_counts_expand_nothing(spark, base):
    o = spark.read.parquet(f"{base}/orders.parquet")
    plan = plan_text(sketches.distinct_exact(o, ["o_custkey", "o_orderdate"]), "simple")
    assert "Expand" not in plan and plan.count("FileScan") == 2
    assert all(line.count("o_custkey") + line.count("o_orderdate") <= 2 for line in plan.splitlines() if "ReadSchema" in line)
    assert "Expand" in plan_text(o.agg(F.count_distinct("o_custkey"), F.count_distinct("o_orderdate")), "simple")


def test_quantile_sketches_keep_their_rank_error(spark):
    n = 40000
    df = spark.range(n).select((F.col("id") % 4).alias("g"), F.floor(F.col("id") / 3000).alias("day"), ((F.col("id") * 7919) % 100003).alias("v"))
    merged = sketches.merge_quantiles(sketches.quantile_sketches(df, ["g", "day"], "v"), ["g"])
    for q in (0.1, 0.5, 0.9):
        for g, size, est in rows(sketches.estimate_quantile(merged, q), "g", "n", "estimate"):
            below = df.filter((F.col("g") == g) & (F.col("v") <= est)).count()
            assert size == n / 4 and abs(below / size - q) <= 2 * sketches.KLL_ERROR
    none = sketches.quantile_sketches(df.filter("v < 0"), ["g"], "v")
    assert none.count() == 0


def top(values, k):
    c = Counter(values)
    order = sorted(c, key=lambda v: (-c[v], v is not None, v or ""))
    return [(v, c[v], i) for i, v in enumerate(order[:k], 1)]


def test_frequent_values_are_exact(spark):
    skewed = ["hot"] * 400 + [None] * 60 + [f"v{i % 300}" for i in range(900)] + [f"w{i}" for i in range(500)] + ["tie"] * 60
    cases = {"skewed": skewed, "flat": [f"u{i}" for i in range(300)], "few": ["a", "b", "b"], "nothing": []}
    for name, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values], "c string").repartition(4)
        for buckets in (3, 16):  # with 8 buckets nearly every value shares one
            got = sketches.frequent_values(df, "c", k=5, log2_buckets=buckets)
            assert sorted(rows(got, "value", "n", "rank"), key=lambda r: r[2]) == top(values, 5), (name, buckets)
    df = spark.createDataFrame([(v,) for v in skewed], "c string")
    halves = [sketches.hashed_counts(df.filter(p), "c") for p in (F.col("c") < "v2", ~F.coalesce(F.col("c") < "v2", F.lit(False)))]
    merged = sketches.frequent_values(df, "c", k=5, counts=halves[0].unionByName(halves[1]))
    assert sorted(rows(merged), key=str) == sorted(rows(profile.top_values(df, ["c"], k=5).select("column", "value", "n", "rank")), key=str)


def test_frequent_values_group_few_rows(spark):
    """Of 50,000 values, only those in buckets as full as the tenth value are grouped."""
    df = spark.range(60000).select(F.when(F.col("id") < 10000, F.col("id") % 10).otherwise(F.col("id")).alias("c"))
    plan = sketches.frequent_values(df, "c", k=10)
    assert sorted(n for n, in rows(plan, "n")) == [1000] * 10
    text = plan_text(plan, "simple")
    assert text.count("LeftSemi") == 2 and "SortMergeJoin" not in text


def test_key_filter_has_no_false_negative(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    for bits in (8, 16):
        held = sketches.key_filter(keys, "k", bits)
        assert held.count() == 1 and len(held.first().bits) == 1 << (bits - 6)
        probe = spark.range(3000).select("id", sketches.may_hold(held.scalar(), F.col("id"), bits).alias("may"))
        found = {i for i, m in rows(probe) if m}
        assert found >= set(range(0, 3000, 3))
    assert len(found) < 1000 + 0.05 * 2000
    empty = sketches.key_filter(keys.filter("k < 0"), "k", 8).scalar()
    assert not any(m for m, in rows(spark.range(50).select(sketches.may_hold(empty, F.col("id"), 8))))


def test_prefiltered_tag_joins_possible_members_only(spark):
    facts = spark.range(20000).select(F.when(F.col("id") % 50 != 7, F.col("id") % 5000).alias("k"), F.col("id").alias("f"))
    keys = per_key(spark.range(0, 5000, 100).select(F.col("id").alias("k")), "k")
    want = sorted(rows(cohort.tag(facts, keys, "k")), key=str)
    for bits in (6, 16):  # with 64 bits nearly all facts are joined
        assert sorted(rows(cohort.tag_prefiltered(facts, keys, "k", log2_bits=bits)), key=str) == want
    text = plan_text(cohort.tag_prefiltered(facts, keys, "k"), "simple")
    assert "Subquery" in text and "Union" in text
    possible = facts.filter(sketches.may_hold(sketches.key_filter(keys, "k").scalar(), F.col("k")))
    assert possible.count() == facts.filter("k % 100 = 0").count()


def test_samples_merge_and_repeat(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 4).alias("g"))
    want = sorted(range(1000), key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())[:50]
    assert {k for k, in rows(profile.sample_rows(df, 50, "k", seed=3), "k")} == set(want)
    assert {k for k, in rows(profile.sample_rows(df.repartition(7), 50, "k", seed=3), "k")} == set(want)
    halves = [profile.sample_rows(df.filter(p), 50, "k", seed=3) for p in ("k < 600", "k >= 600")]
    assert {k for k, in rows(profile.sample_rows(halves[0].union(halves[1]), 50, "k", seed=3), "k")} == set(want)
    by = rows(profile.sample_rows(df, 20, "k", seed=3, by=["g"]), "g", "k")
    assert Counter(g for g, _ in by) == {0: 20, 1: 20, 2: 20, 3: 20}
    assert "WindowGroupLimit" in plan_text(profile.sample_rows(df, 20, "k", by=["g"]), "simple")
    assert profile.sample_rows(df, 5000, "k").count() == 1000 and profile.sample_rows(df.limit(0), 5, "k").count() == 0
    assert profile.sample_rows(spark.createDataFrame([(None,), (1,)], "k long"), 5, "k").count() == 2


def test_missing_months(spark):
    data = [("a", "m", f"2020-{i:02d}-01") for i in range(1, 13) if i not in (3, 4, 11)] + [("b", None, "2021-05-01"), ("b", None, "2021-07-31"), ("c", "m", None)]
    s = spark.createDataFrame(data, "industry string, metric string, d string").select("industry", "metric", F.to_date("d").alias("obs_date"))
    got = sorted((i, m, str(d)) for i, m, d in rows(series.missing_months(s)) if i == "a")
    assert got == [("a", "m", "2020-03-01"), ("a", "m", "2020-04-01"), ("a", "m", "2020-11-01")]
    assert [(m, str(d)) for i, m, d in rows(series.missing_months(s)) if i == "b"] == [(None, "2021-06-01")]
    wide = [str(d) for i, _, d in rows(series.missing_months(s, first="2019-12-15", last="2020-03-01")) if i == "a"]
    assert sorted(wide) == ["2019-12-01", "2020-03-01"]
    assert series.missing_months(s, first="2022-01-01", last="2021-01-01").count() == 0 and series.missing_months(s.limit(0)).count() == 0


def test_bucketed_bridge_has_no_exchange(spark, base):
    from cohortkit.plans import catalog

    plan = plan_text(catalog.bucketed_bridge(spark, base), "simple")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
