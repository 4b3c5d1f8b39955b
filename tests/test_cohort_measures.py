import itertools

from pyspark.sql import functions as F

from cohortkit.operators import cohort, fuzzy, measures
from tests.conftest import rows


def test_members_distinct_non_null_with_a_measure(spark):
    ev = spark.createDataFrame([("a", 1, None), ("a", 2, None), (None, 1, 1.0), ("b", None, None), ("c", None, 0.5)],
                               "k string, total int, pct double")
    got = sorted(r[0] for r in rows(cohort.members(ev, "k", ["total", "pct"])))
    assert got == ["a", "c"]


def test_tag_labels_and_drops_null_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, k string")
    mem = spark.createDataFrame([("a",)], "k string")
    got = sorted(rows(cohort.tag(facts, mem, "k"), "id", "cohort"))
    assert got == [(1, "flagged"), (2, "rest")]


def test_join_diagnostic_zero_safe(spark):
    facts = spark.createDataFrame([(1, "a")], "id int, k string")
    ev = spark.createDataFrame([], "k string")
    got = {m: v for _, m, v in rows(cohort.join_diagnostic(facts, ev, "k", "k"))}
    assert got["key_hit_pct"] == "0.0" and got["distinct_member_keys"] == "0" and got["fact_share_pct"] == "0.0"


def test_top_k_tie_break_and_blank_exclusion(spark):
    data = [("x", s) for s in ["b", "a", "c", "c", "", None]]
    df = spark.createDataFrame(data, "cohort string, state string")
    keep = F.col("state").isNotNull() & (F.col("state") != "")
    got = rows(measures.top_k(df, "cohort", "state", k=2, keep=keep).orderBy("rank"), "state", "n", "pct_of_cohort")
    assert got == [("c", 2, 50.0), ("a", 1, 25.0)]


def test_share_and_cumulative(spark):
    df = spark.createDataFrame([("x", 3, 1), ("x", 1, 2), ("y", 2, 1)], "cohort string, n bigint, r int")
    got = rows(measures.cumulative_share(df, "cohort", "r").orderBy("cohort", "r"), "cohort", "cum_n", "cum_pct")
    assert got == [("x", 3, 75.0), ("x", 4, 100.0), ("y", 2, 100.0)]


def test_group_median_exact_interpolates(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 10.0), ("g", 11.0)], "g string, v double")
    assert rows(measures.group_median(df, ["g"], "v", exact=True), "median", "n") == [(6.0, 4)]
    assert rows(measures.group_median(df, ["g"], "v"), "median") == [(2.0,)]


def test_pivot_cohorts_names(spark):
    df = spark.createDataFrame([("L", "flagged", 1.0, 3), ("L", "rest", 2.0, 4)], "level string, cohort string, m double, n int")
    wide = measures.pivot_cohorts(df, ["level"], "cohort", {"m": F.first("m"), "n": F.first("n")}, ["flagged", "rest"])
    assert rows(wide, "level", "m_flagged", "m_rest", "n_flagged", "n_rest") == [("L", 1.0, 2.0, 3, 4)]


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_fuzzy_pairs_match_brute_force(spark):
    left = ["acme", "acne", "zinc", "z", "", "abc", "abcd", "bcd", "customer#12,", "q"]
    right = ["acme", "acmes", "cme", "zinc.", "ab", "abd", "customer#12", "customer#13", "", "xyz", "q", "qq"]
    for d in (1, 2):
        want = sorted((a, b, _lev(a, b)) for a, b in itertools.product(set(left), set(right))
                      if a != b and _lev(a, b) <= d)
        ldf = spark.createDataFrame([(x,) for x in left], "k string")
        rdf = spark.createDataFrame([(x,) for x in right], "k string")
        got = sorted(rows(fuzzy.fuzzy_pairs(ldf, "k", rdf, "k", d)))
        assert got == want, d


def test_both_sided_strata(spark):
    df = spark.createDataFrame([("s1", "flagged", 1), ("s1", "rest", 2), ("s2", "rest", 3)], "s string, cohort string, n int")
    assert sorted(r[0] for r in rows(cohort.both_sided_strata(df, "s"), "s")) == ["s1", "s1"]


def test_exact_median_matches_builtin_on_skewed_groups(spark):
    import random

    from cohortkit.operators.quantiles import exact_median

    rnd = random.Random(7)
    data = [("hot", rnd.randint(-10**12, 10**12)) for _ in range(3000)]
    data += [("hot", 5)] * 500 + [("cold", rnd.randint(0, 50)) for _ in range(7)] + [("one", 42), (None, 3), (None, 9)]
    df = spark.createDataFrame(data, "g string, v bigint")
    got = sorted(rows(exact_median(df, ["g"], "v"), "g", "median", "n"), key=str)
    want = sorted(rows(df.groupBy("g").agg(F.median("v").alias("m"), F.count("v").alias("n")), "g", "m", "n"),
                  key=str)
    assert got == want


def test_exact_median_spans_the_whole_integer_range_and_keeps_nothing_cached(spark):
    from cohortkit.operators.quantiles import exact_median

    df = spark.createDataFrame([("a", -2**63), ("a", 2**63 - 1), ("a", 5), ("b", 2**63 - 1), ("b", -2**63)], "g string, v bigint")
    got = sorted(rows(exact_median(df, ["g"], "v"), "g", "median", "n"))
    assert got == [("a", 5.0, 3), ("b", -0.5, 2)]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_bootstrap_rate_survives_totals_beyond_32_bits(spark):
    from cohortkit.operators import resample

    big = spark.range(4).select(F.col("id"), F.when(F.col("id") == 0, "in").otherwise("out").alias("cohort"))
    # totals are multiplied in DECIMAL; the same expression with these factors overflows BIGINT
    wide = spark.sql("SELECT (CAST(4294967296 AS DECIMAL(20, 0)) * CAST(5000000000 AS DECIMAL(18, 0))) div 7000000000 AS t").first()[0]
    assert wide == 4294967296 * 5000000000 // 7000000000
    r = resample.bootstrap_rate(big, "cohort", "in", "out", F.lit(True), reps=16).first()
    assert (r["reps"], r["observed_total"], r["observed_n"]) == (16, 1, 1)
