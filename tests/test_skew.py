"""A key holding a third of the facts: the tag join is split by AQE, results stay whole."""

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import cohort, integrity, measures
from cohortkit.operators.joins import per_key
from tests.conftest import plan_text, rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_key_tag_join_is_split_and_complete(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        facts = spark.range(n).select(F.col("id").alias("fid"),
                                      F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
        mem = spark.range(0, n, 2).select(F.col("id").alias("k"))
        tagged = cohort.tag(facts, mem, "k")
        counts = tagged.groupBy("cohort").count()
        got = dict((r["cohort"], r["count"]) for r in counts.collect())
        # key 0 is a member (10,000 rows); other even ids are members
        want_flagged = n // 3 + sum(1 for i in range(n) if i % 3 != 0 and i % 2 == 0)
        assert got == {"flagged": want_flagged, "rest": n - want_flagged}
        plan = plan_text(tagged, "simple")
        tagged.collect()  # finalizes this frame's adaptive plan
        final = plan_text(tagged, "simple")
        assert "SortMergeJoin" in plan + final
        assert "skew=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_group_median_and_topk_are_exact(spark):
    # one category with a third of the rows: aggregation is partial, top-k bounded, values exact
    rows_ = [("c", "hot", i % 997) for i in range(9000)] + [("c", f"k{i % 50}", i) for i in range(18000)]
    df = spark.createDataFrame(rows_, "cohort string, cat string, v bigint")
    top = measures.top_k(df, "cohort", "cat", k=3).orderBy("rank").collect()
    assert [(r["cat"], r["n"]) for r in top] == [("hot", 9000), ("k0", 360), ("k1", 360)]
    med = measures.group_median(df.filter(F.col("cat") == "hot"), ["cat"], "v", exact=True).collect()[0]
    want = df.filter(F.col("cat") == "hot").agg(F.median("v")).collect()[0][0]
    assert med["median"] == want and med["n"] == 9000


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _facts(spark, n=30000):
    """One key holds a third of the rows, and no column tells the rows of a key apart (the payload repeats)."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                 F.sha2((F.col("id") % 977).cast("string"), 256).alias("payload"))


def test_tag_by_a_derived_member_set_splits_a_hot_key(skew_conf):
    spark, n = skew_conf, 30000
    ev = spark.range(0, 3 * n).select((F.col("id") % n).alias("k"), (F.col("id") % 7).alias("v"))
    tagged = cohort.tag(_facts(spark), cohort.members(ev.filter(F.col("k") % 2 == 0), "k", ["v"]), "k")
    sizes = [len(p) for p in tagged.rdd.mapPartitions(lambda it: [list(it)]).collect()]
    assert sum(sizes) == n
    assert max(sizes) < n // 6, max(sizes)  # the 10,000 rows of key 0 are spread
    tagged.collect()
    assert "skew=true" in plan_text(tagged, "simple")
    want = n // 3 + sum(1 for i in range(n) if i % 3 and i % 2 == 0)
    assert {r["cohort"]: r["count"] for r in tagged.groupBy("cohort").count().collect()} == {"flagged": want, "rest": n - want}


def test_counting_measures_join_counts_not_rows(skew_conf):
    spark, n = skew_conf, 30000
    facts, mem = _facts(spark), spark.range(0, n, 2).select(F.col("id").alias("k"))
    counts = cohort.key_counts(facts, "k")
    largest = max(len(p) for p in counts.rdd.mapPartitions(lambda it: [list(it)]).collect())
    assert largest <= counts.count() // 2  # the hot key is one row
    want = n // 3 + sum(1 for i in range(n) if i % 3 and i % 2 == 0)
    assert rows(cohort.semi_join_count(facts, mem, "k")) == [(want,)]
    got = rows(integrity.orphans(facts, mem, "k", "k"))
    assert got[0][:2] == (n - want, n)
    plain = measures.flag_rate(cohort.tag(facts, mem, "k"), "cohort", F.col("k") % 4 == 0)
    by_count = measures.flag_rate(cohort.tag(cohort.key_counts(facts, "k", {"f": F.col("k") % 4 == 0}), mem, "k"),
                                  "cohort", F.col("f"), weight="n")
    assert sorted(rows(plain)) == sorted(rows(by_count))


def test_per_key_joins_equal_plain_joins(spark):
    left = spark.range(6000).select(F.col("id").alias("lid"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"))
    dup = spark.range(0, 1500).select((F.col("id") % 250 * 2).alias("rk"), F.col("id").alias("p"))
    right = per_key(dup, "rk", F.max("p").alias("p"))
    want = dup.groupBy("rk").agg(F.max("p").alias("p"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        a = left.join(want, F.col("k") == F.col("rk"), how)
        b = left.join(right, F.col("k") == F.col("rk"), how)
        assert sorted(rows(a), key=str) == sorted(rows(b), key=str), how
