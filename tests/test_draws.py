"""Random counts against their exact laws, the shared rank search, and baselines that draw no rows."""

import math
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cohortkit.functions import draws
from cohortkit.operators import resample
from cohortkit.operators.quantiles import counted, values_at_ranks
from tests.conftest import plan_text, rows

N = 20000


def close(got: Counter, law: dict):
    """All counts within 5 standard deviations of their law (N draws), and nothing outside its support."""
    assert set(got) <= {x for x, p in law.items() if p > 0} and sum(got.values()) == N
    for x, p in law.items():
        assert abs(got[x] - N * p) <= 5 * math.sqrt(N * p * (1 - p)) + 1, (x, got[x], N * p)


def drawn(spark, sql):
    return Counter(x for (x,) in rows(spark.range(N).select(F.expr(sql))))


@pytest.mark.parametrize(("total", "good", "take"), [(10, 4, 5), (10, 0, 5), (10, 10, 3), (7, 3, 7), (0, 0, 0), (400, 130, 60), (1, 1, 1), (50, 49, 48)])
def test_hypergeometric_law(spark, total, good, take):
    law = {x: math.comb(good, x) * math.comb(total - good, take - x) / math.comb(total, take) for x in range(max(0, take + good - total), min(good, take) + 1)}
    close(drawn(spark, draws.hypergeometric_sql(f"{total}L", f"{good}L", f"{take}L", draws.uniform_sql("'t'", "id"))), law)


@pytest.mark.parametrize(("n", "good", "total"), [(10, 3, 7), (5, 0, 4), (5, 4, 4), (0, 2, 3), (80, 1, 90)])
def test_binomial_law(spark, n, good, total):
    q = good / total
    law = {x: math.comb(n, x) * q**x * (1 - q) ** (n - x) for x in range(n + 1)}
    close(drawn(spark, draws.binomial_sql(f"{n}L", f"{good}L", f"{total}L", draws.uniform_sql("'b'", "id"))), law)


@pytest.mark.parametrize("replace", [False, True])
def test_sampled_ranks_have_the_law_of_a_sample(spark, replace):
    total, take = 7, 4
    one = F.struct(*[draws.sample_rank(f"{total}L", f"{take}L", f"{k}L", replace, "'r'", "id").alias(f"k{k}") for k in (2, 3)])
    got = Counter(tuple(r) for (r,) in rows(spark.range(N).select(one)))
    if replace:  # all ordered samples
        from itertools import product

        every = [tuple(sorted(s)) for s in product(range(1, total + 1), repeat=take)]
    else:
        every = list(combinations(range(1, total + 1), take))
    law = Counter((s[1], s[2]) for s in every)  # both middle ranks of one sample
    close(got, {x: c / len(every) for x, c in law.items()})
    pairs = Counter(tuple(r) for (r,) in rows(spark.range(N).select(draws.sample_middle_ranks(f"{total}L", f"{take}L", replace, "'r'", "id"))))
    assert pairs == got  # the two middle ranks share their way down
    odd = spark.range(500).select(draws.sample_middle_ranks("9L", "5L", replace, "'o'", "id").alias("m"), draws.sample_rank("9L", "5L", "3L", replace, "'o'", "id").alias("r"))
    assert all(m == [r] for m, r in rows(odd))


def test_draws_of_large_counts_are_few_steps_wide(spark):
    sql = draws.hypergeometric_sql("1000000000000L", "250000000000L", "4000000L", draws.uniform_sql("'h'", "id"))
    mean, spread = spark.range(300).select(F.expr(sql).alias("x")).agg(F.avg("x"), F.stddev("x")).first()
    sd = math.sqrt(4e6 * 0.25 * 0.75)
    assert abs(mean - 1e6) < 5 * sd / math.sqrt(300) and 0.8 * sd < spread < 1.2 * sd
    assert resample_ranks_fit(spark)


def resample_ranks_fit(spark):
    total, take = 10**12, 10**4
    r = [x for (x,) in rows(spark.range(200).select(draws.sample_rank(f"{total}L", f"{take}L", "5000L", False, "'w'", "id")))]
    sd = total / (2 * math.sqrt(take))
    return abs(sum(r) / 200 - total / 2) < 5 * sd / math.sqrt(200) and min(r) >= 5000


@pytest.mark.parametrize("scale", [1, 2**20, 2**40, 2**54])
def test_values_at_ranks_equal_sorting(spark, scale):
    data = [(g, ((i * i * 7919) % 211 - 100) * scale) for g in (0, 1, None) for i in range(300 if g == 0 else 40)]
    values = counted(spark.createDataFrame(data, "g int, __v long"), ["g"])
    asked = [(g, k, f"t{j}") for g, n in ((0, 300), (1, 40), (None, 40)) for j, k in enumerate((1, 2, n // 2, n // 2, n))]
    got = values_at_ranks(values, spark.createDataFrame(asked, "g int, k long, name string"), ["g"])
    by = {g: sorted(v for h, v in data if h == g) for g in (0, 1, None)}
    assert sorted(rows(got, "g", "k", "name", "value"), key=str) == sorted(((g, k, n, by[g][k - 1]) for g, k, n in asked), key=str)


def test_values_at_ranks_of_the_whole_64_bit_range_and_of_nothing(spark):
    ends = spark.createDataFrame([(-2**63, 1), (-1, 5), (0, 1), (2**63 - 1, 2)], "__v long, __n long")
    got = values_at_ranks(ends, spark.createDataFrame([(k,) for k in range(1, 10)], "k long"), [])
    assert [v for _, v in sorted(rows(got, "k", "value"))] == [-2**63] + [-1] * 5 + [0] + [2**63 - 1] * 2
    assert values_at_ranks(ends.limit(0), spark.createDataFrame([], "k long"), []).count() == 0


def baseline(spark, n=400):
    return spark.range(n).select(F.when(F.col("id") % 5 == 0, "in").when(F.col("id") % 7 == 0, F.lit(None)).otherwise("out").alias("cohort"),
                                 F.when(F.col("id") % 11 != 0, (F.col("id") * 37) % 101).alias("v"), (F.col("id") % 3 == 0).alias("hit"))


def test_baselines_without_rows(spark):
    t = baseline(spark)
    for empty in (t.limit(0), t.filter("cohort = 'in'"), t.filter("cohort = 'out'")):
        r = resample.bootstrap_rate(empty, "cohort", "in", "out", F.col("hit"), reps=20).first()
        assert (r.reps, r.drawn_rows, r.reach) == (20, 0, 0)
        m = resample.median_baseline(empty, "cohort", "in", "out", "v", reps=20).first()
        assert (m.reps, m.reach) == (0, 0)
    b = resample.bootstrap_median(t.limit(0), "v", reps=20).first()
    assert (b.reps, b.n, b.median, b.ci_low) == (0, 0, None, None)


def test_median_draws_equal_drawing_rows(spark):
    """The share of draws that reach the observed median, against draws of rows."""
    import random

    t = baseline(spark)
    data = [(c, v) for c, v in rows(t, "cohort", "v") if v is not None]
    own, pop = sorted(v for c, v in data if c == "in"), [v for c, v in data if c == "out"]
    mid = lambda s: (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2
    rng = random.Random(1)
    want = sum(mid(sorted(rng.sample(pop, len(own)))) >= mid(own) for _ in range(4000)) / 4000
    r = resample.median_baseline(t, "cohort", "in", "out", "v", reps=2000).first()
    assert (r.observed_n, r.observed_median, r.drawn_rows) == (len(own), mid(own), 2000 * len(own))
    assert abs(r.reach / 2000 - want) < 5 * math.sqrt(want * (1 - want) * (1 / 2000 + 1 / 4000)) + 1e-9
    cell = t.filter("cohort = 'in'")
    got = resample.bootstrap_median(cell, "v", reps=400).first()
    sims = sorted(mid(sorted(rng.choices(own, k=len(own)))) for _ in range(4000))
    assert got.median == mid(own) and got.reps == 400
    assert sims[20] <= got.ci_low <= sims[300] and sims[-301] <= got.ci_high <= sims[-21]


def test_no_row_is_multiplied(spark):
    """The only generator runs over replicates; tagged rows reach an aggregate before anything else."""
    t = spark.range(5000).select(F.when(F.col("id") % 5 == 0, "in").otherwise("out").alias("cohort"), F.col("id").alias("v"))
    rate = plan_text(resample.bootstrap_rate(t, "cohort", "in", "out", F.col("v") > 9), "simple")
    assert "Generate" not in rate and "Join" not in rate
    median = plan_text(resample.median_baseline(t, "cohort", "in", "out", "v"), "simple")
    assert "NestedLoop" not in median and "Cartesian" not in median
    assert all("__v" not in line for line in median.splitlines() if "Generate" in line)
