"""Noise baselines that draw rows, against drawing them one by one."""

import hashlib
from statistics import median

import pytest

from cohortkit.operators import resample
from pyspark.sql import functions as F


def data(n=900):
    """``id, cohort, v, hit``: ids that repeat (with other values, too) and null ids, values and flags."""
    out = [(i, "in" if i % 4 == 0 else "out" if i % 9 else None, (i * i * 37) % 211 if i % 13 else None, i % 3 == 0 if i % 17 else None) for i in range(n)]
    return out + [r for r in out if r[0] % 5 == 0] + [(i, "out", 500, True) for i in range(1, 60)] + [(None, "out", 1000 + i, i % 2 == 0) for i in range(20)]


def taken(pop, take, reps):
    """Each replicate's rows ``(id, v)`` with the smallest draws; ties by id and value, null ids last."""
    for rep in range(1, reps + 1):
        def place(row):
            if row[0] is None:
                return (1, "", 0, row[1])
            h = hashlib.sha256(f"{row[0]}:{(rep - 1) // 8}".encode()).hexdigest()
            return (0, h[8 * ((rep - 1) % 8):][:8], row[0], row[1])

        yield [v for _, v in sorted(pop, key=place)[:take]]


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("reps", [1, 27])
def test_draws_take_the_rows_with_the_smallest_hashes(spark, whole, reps):
    rows = [r for r in data() if not whole or r[1] == "in" or r[0] is None or r[0] % 7 == 0]  # whole: a draw takes all
    t = spark.createDataFrame(rows, "id long, cohort string, v long, hit boolean")
    own, pop = [bool(h) for _, c, _, h in rows if c == "in"], [(i, bool(h)) for i, c, _, h in rows if c == "out"]
    take = min(len(own), len(pop))
    assert (take == len(pop)) == whole
    got = resample.drawn_rate(t, "cohort", "in", "out", "id", F.col("hit"), reps=reps).first()
    reach = sum(sum(s) * len(own) >= sum(own) * take for s in taken(pop, take, reps))
    assert (got.reps, got.observed_total, got.observed_n, got.drawn_rows, got.reach) == (reps, len(own), sum(own), take * reps, reach)
    own, pop = [v for _, c, v, _ in rows if c == "in" and v is not None], [(i, v) for i, c, v, _ in rows if c == "out" and v is not None]
    take = min(len(own), len(pop))
    got = resample.drawn_median(t, "cohort", "in", "out", "id", "v", reps=reps).first()
    reach = sum(median(s) >= median(own) for s in taken(pop, take, reps))
    assert (got.reps, got.observed_n, got.observed_median, got.drawn_rows, got.reach) == (reps, len(own), median(own), take * reps, reach)


def test_draws_that_count_most_rows_equal_drawing_all(spark):
    """So many rows that those far from the last one and from the middle are only counted."""
    n, reps = 20000, 3
    t = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "in").otherwise("out").alias("cohort"), ((F.col("id") * 7919) % 10007).alias("v"))
    pop = [(i, (i * 7919) % 10007) for i in range(n) if i % 3]
    own = [(i * 7919) % 10007 for i in range(0, n, 3)]
    drawn = list(taken(pop, len(own), reps))
    got = resample.drawn_median(t, "cohort", "in", "out", "id", "v", reps=reps).first()
    assert (got.reps, got.drawn_rows, got.reach) == (reps, reps * len(own), sum(median(s) >= median(own) for s in drawn))
    got = resample.drawn_rate(t, "cohort", "in", "out", "id", F.col("v") < 5000, reps=reps).first()
    assert got.reach == sum(sum(v < 5000 for v in s) >= sum(v < 5000 for v in own) for s in drawn)


def test_draws_without_rows(spark):
    t = spark.createDataFrame(data(60), "id long, cohort string, v long, hit boolean")
    for few in (t.limit(0), t.filter("cohort = 'in'"), t.filter("cohort = 'out'")):
        r = resample.drawn_rate(few, "cohort", "in", "out", "id", F.col("hit"), reps=9).first()
        assert (r.reps, r.drawn_rows, r.reach, r.observed_total) == (9, 0, 0, few.filter("cohort = 'in'").count())
        m = resample.drawn_median(few, "cohort", "in", "out", "id", "v", reps=9).first()
        assert (m.reps, m.reach, m.drawn_rows, m.reach_share) == (0, 0, None, None)


def test_queries_draw_rows(spark, base, monkeypatch):
    """The registered baselines draw rows of the tables, every replicate as many as the observed cohort has."""
    from cohortkit.plans import catalog

    seen, draws = [], resample._draws
    monkeypatch.setattr(resample, "_draws", lambda rows, reps, high: seen.append(reps) or draws(rows, reps, high))
    for query in (catalog.bootstrap_rate, catalog.bootstrap_median_baseline):
        query(spark, base)
    assert seen == [1000, 1000]
