
from cohortkit.operators import profile, rules
from tests.conftest import rows


def test_inverted_range_keeps_null_bounds(spark):
    df = spark.createDataFrame([(1, 10.0, 5.0), (2, 5.0, 10.0), (3, 5.0, 5.0), (4, None, 5.0), (5, 5.0, None)],
                               "id int, lo double, hi double")
    kept = rules.apply_rules(df, [rules.Rule("inv", rules.inverted_range("lo", "hi"))])
    assert sorted(r[0] for r in rows(kept, "id")) == [2, 3, 4, 5]


def test_bounds_inclusive_and_null_kept(spark):
    df = spark.createDataFrame([(1, 9999.99), (2, 10000.0), (3, 1000000.0), (4, 1000000.01), (5, None)],
                               "id int, v double")
    kept = rules.apply_rules(df, [rules.Rule("b", rules.out_of_bounds("v", 10000, 1000000))])
    assert sorted(r[0] for r in rows(kept, "id")) == [2, 3, 5]


def test_all_null(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, None), (3, None, 0.5)], "id int, a int, b double")
    kept = rules.apply_rules(df, [rules.Rule("n", rules.all_null(["a", "b"]))])
    assert sorted(r[0] for r in rows(kept, "id")) == [2, 3]


def test_period_sentinel_drops_null_too(spark):
    df = spark.createDataFrame([("M01",), ("M13",), (None,)], "period string")
    kept = rules.apply_rules(df, [rules.Rule("p", rules.equals("period", "M13"))])
    assert rows(kept) == [("M01",)]


def test_audit_counts_first_failing_rule_once(spark):
    df = spark.createDataFrame([(10.0, 5.0, 1.0), (10.0, 5.0, 50000.0), (1.0, 2.0, 1.0), (1.0, 2.0, 50000.0)],
                               "lo double, hi double, v double")
    rs = [rules.Rule("inverted", rules.inverted_range("lo", "hi")),
          rules.Rule("bounds", rules.out_of_bounds("v", 10000, 1000000))]
    got = {m: v for _, m, v in rows(rules.audit(df, rs, "t"))}
    assert got == {"raw_row_count": 4, "final_row_count": 1, "dropped_inverted": 2, "dropped_bounds": 1,
                   "total_dropped": 3}
    assert got["raw_row_count"] == got["final_row_count"] + got["dropped_inverted"] + got["dropped_bounds"]


def test_profile_distinct_counts_null_and_blank(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "c string")
    p = {(c, m): v for _, c, m, v in rows(profile.profile(df, "t", distinct_cols=["c"]))}
    assert p[("c", "distinct_count")] == "4" and p[("c", "null_count")] == "1"
    assert p[("_dataset", "row_count")] == "4"
    b = {(c, m): v for _, c, m, v in rows(profile.profile(df, "t", blank_is_null=True))}
    assert b[("c", "null_or_blank_count")] == "2"


def test_top_values_null_is_a_value_and_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), ("c",)], "c string")
    got = rows(profile.top_values(df, ["c"], k=3), "value", "n", "rank")
    assert got == [(None, 2, 1), ("a", 1, 2), ("b", 1, 3)] or sorted(got, key=lambda r: r[2]) == [
        (None, 2, 1), ("a", 1, 2), ("b", 1, 3)]


def test_numeric_summary_is_numeric_not_lexicographic(spark):
    df = spark.createDataFrame([("9",), ("100000",), ("20",)], "v string")
    got = {m: v for _, m, v in rows(profile.numeric_summary(df, ["v"]))}
    assert got["min"] == 9.0 and got["max"] == 100000.0 and got["mean"] == 33343.0


def test_profile_approx_distinct_close_to_exact(spark):
    df = spark.range(20000).selectExpr("id % 5000 AS k", "CAST(NULL AS STRING) AS s")
    exact = {c: int(v) for _, c, m, v in rows(profile.profile(df, "t", distinct_cols=["k", "s"])) if m == "distinct_count"}
    approx = {c: int(v) for _, c, m, v in rows(profile.profile(df, "t", distinct_cols=["k", "s"], approx_distinct=True))
              if m == "distinct_count"}
    assert exact == {"k": 5000, "s": 1}
    # approx_count_distinct has a 5 % relative standard deviation by default: allow 3 sigma
    assert abs(approx["k"] - 5000) <= 750 and approx["s"] == 1


def test_one_pass_writes_and_counts(spark, tmp_path):
    from pyspark.sql import functions as F

    from tests.conftest import plan_text

    src = str(tmp_path / "raw")
    spark.range(1000).selectExpr("id", "IF(id % 7 = 0, 5.0, 1.0) AS lo", "IF(id % 3 = 0, NULL, 2.0) AS hi", "id * 1000.0 AS v").write.parquet(src)
    df = spark.read.parquet(src)
    rs = [rules.Rule("inverted", rules.inverted_range("lo", "hi")), rules.Rule("bounds", rules.out_of_bounds("v", 10000, 900000))]
    clean, _ = rules.observed_rules(df, rs)
    plan = plan_text(clean, "simple")
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1 and "Exchange" not in plan and "Aggregate" not in plan
    out = str(tmp_path / "clean")
    a = rules.write_clean(df, rs, "t", out, then=lambda d: d.withColumn("w", F.col("v") * 2), checks={"no_hi": F.col("hi").isNull()})
    got = {m: v for _, m, v in rows(a)}
    want = {m: v for _, m, v in rows(rules.audit(df, rs, "t"))}
    back = spark.read.parquet(out)
    assert got == want | {"no_hi": back.filter("hi IS NULL").count()} and back.columns == ["id", "lo", "hi", "v", "w"]
    assert sorted(rows(back.drop("w"))) == sorted(rows(rules.apply_rules(df, rs))) and len(rows(back)) == got["final_row_count"] > 0


def test_one_pass_of_nothing_and_of_nothing_left(spark, tmp_path):
    rs = [rules.Rule("all", rules.not_in("c", ["x"]))]
    for name, df in (("none", spark.createDataFrame([], "c string")), ("left", spark.createDataFrame([("a",), (None,)], "c string"))):
        n = df.count()
        got = {m: v for _, m, v in rows(rules.write_clean(df, rs, name, str(tmp_path / name)))}
        assert got == {"raw_row_count": n, "final_row_count": 0, "dropped_all": n, "total_dropped": n}
        assert spark.read.parquet(str(tmp_path / name)).columns == ["c"]
