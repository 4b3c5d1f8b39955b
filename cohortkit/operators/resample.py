"""Resampled noise baselines: draws of rows, and closed laws of such draws.

``drawn_rate`` and ``drawn_median`` draw rows: in every replicate a row has a
32-bit number from ``sha256(row id || ':' || block)``, eight replicates to a
block, and the rows with the smallest numbers are taken.  The numbers are made
inside each task.  Only rows near a replicate's last one, or near the middle of
its values, leave the task one by one; all others leave it as counts.

``bootstrap_rate``, ``median_baseline`` and ``bootstrap_median`` draw no row.  A
rate needs only how many hits an equal-size draw holds, a hypergeometric count
of three numbers.  A median needs only which rank of the population the middle of
a draw has, and that has a closed law too (``functions.draws``).  Their draws
follow from the SHA-256 of the replicate's number.

Any SQL engine can repeat both.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.draws import hypergeometric, sample_middle_ranks
from cohortkit.functions.numeric import pct, round_half_up_ratio
from cohortkit.operators.quantiles import counted, values_at_ranks, written

TWO_32 = 1 << 32
SLOTS = 8  # 32-bit draws of a SHA-256 digest (64 hex digits)
LAST = "g"  # the draw of a row without an id: behind all hex digits


def _replicates(df: DataFrame, reps: int) -> DataFrame:
    return df.sparkSession.range(1, reps + 1).select(F.col("id").alias("rep"))


def _draws(rows: DataFrame, reps: int, high: str) -> DataFrame:
    """``rows`` (with ``__id``) once for each replicate whose ``draw`` (8 hex digits) is at most ``high``.

    Replicate ``r`` (from 1) has slot ``(r - 1) % 8`` of block ``(r - 1) div 8``.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = rows.repartition(parts).withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit((reps - 1) // SLOTS))))
    blocks = blocks.withColumn("__h", F.sha2(F.concat(F.col("__id").cast("string"), F.lit(":"), F.col("__block").cast("string")), 256))
    slots = F.array(*[F.struct(F.lit(j).alias("slot"), F.substring("__h", SLOTS * j + 1, 8).alias("draw")) for j in range(SLOTS)])
    drawn = blocks.select(*rows.columns, "__block", F.explode(slots).alias("__s"))
    rep, draw = F.col("__block") * SLOTS + F.col("__s.slot") + 1, F.coalesce("__s.draw", F.lit(LAST))
    return drawn.select(*rows.columns, rep.cast("long").alias("rep"), draw.alias("draw")).filter((F.col("draw") <= high) & (F.col("rep") <= reps))


def _unless(wrong: Column, value: Column) -> Column:
    return F.when(wrong, F.raise_error(F.lit("a draw lies outside its bounds")).cast("long")).otherwise(value)


def _spread(rows: DataFrame) -> tuple[int, float, int]:
    """Of ``rows`` (``__id``, ``__c`` copies): copies with an id, the mean copies of a row's id, and the most."""
    ids = rows.filter("__id IS NOT NULL").groupBy("__id").agg(F.sum("__c").alias("c"))
    known, squares, most = ids.agg(F.sum("c"), F.sum(F.col("c").cast("double") * F.col("c")), F.max("c")).first()
    return known or 0, squares / known if known else 1.0, most or 1


def _taken(rows: DataFrame, by: list[str], take: int, reps: int, spread: tuple[int, float, int]) -> DataFrame:
    """``rep, by, n``: how many of the ``take`` rows with the smallest draws each replicate has of ``by``; ties by id, then ``by``.

    ``rows`` has ``__id``, ``by`` and ``__c``, its copies.  A replicate's last row
    lies near the share ``take / known`` of all draws: rows far below it (8
    standard deviations) are counted, rows far above are left out, and only those
    between are ranked one by one.  A last row elsewhere is an error, no result.
    """
    known, mean, most = spread
    share = take / max(known, 1)
    room = 8 * math.sqrt(min(share, 1) * mean / max(known, 1)) + 16 * most / max(known, 1)
    low, high = f"{min(max(int((share - room) * TWO_32), 0), TWO_32 - 1):08x}", f"{int((share + room) * TWO_32):08x}" if share + room < 1 else LAST
    alone = F.col("draw") >= low
    kept = _draws(rows, reps, high).groupBy("rep", F.when(alone, F.col("draw")).alias("draw"), F.when(alone, F.col("__id")).alias("__id"), *by).agg(F.sum("__c").alias("__c"))
    order = Window.partitionBy("rep").orderBy(F.asc_nulls_first("draw"), F.asc_nulls_first("__id"), *by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = kept.withColumn("rank", F.sum("__c").over(order))
    n = F.greatest(F.lit(0), F.least("__c", F.lit(take) - F.col("rank") + F.col("__c"))).cast("long")
    counts = ranked.select("rep", *by, _unless(F.col("draw").isNull() & (F.col("rank") > take), n).alias("n"))
    return counts.filter("n > 0").groupBy("rep", *by).agg(F.sum("n").cast("long").alias("n"))


def drawn_rate(tagged: DataFrame, cohort_col: str, observed: str, population: str, id_col: str, flag: Column, reps: int = 1000) -> DataFrame:
    """How often a random draw of rows from cohort ``population`` reaches the flag rate of cohort ``observed``.

    Each replicate takes exactly as many rows as ``observed`` has (all, if there
    are fewer), without replacement: those with the smallest draws, ties by id,
    rows without an id last.  Rates are compared as DECIMAL products.
    """
    side = F.when(F.col(cohort_col) == observed, 0).when(F.col(cohort_col) == population, 1)
    rows = tagged.select(side.alias("side"), F.col(id_col).alias("__id"), F.coalesce(flag, F.lit(False)).alias("hit")).filter("side IS NOT NULL")
    rows = written(rows.groupBy("side", F.when(F.col("side") == 1, F.col("__id")).alias("__id"), "hit").agg(F.count(F.lit(1)).alias("__c")), "drawn-rows")
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("__c"))), F.lit(0)).cast("long")
    total, total_n, size = rows.agg(of(F.col("side") == 0), of((F.col("side") == 0) & F.col("hit")), of(F.col("side") == 1)).first()
    take, pop = min(total, size), rows.filter("side = 1").drop("side")
    taken = _taken(pop, ["hit"], take, reps, _spread(pop)).groupBy("rep").agg(F.sum("n").alias("d"), F.sum(F.when(F.col("hit"), F.col("n"))).alias("k"))
    per = _replicates(tagged, reps).join(taken, "rep", "left").select("rep", F.coalesce("d", F.lit(0)).alias("d"), F.coalesce("k", F.lit(0)).alias("k"))
    wide = lambda c: c.cast("decimal(19,0)")
    reach = (F.col("d") > 0) & (wide(F.col("k")) * wide(F.lit(total)) >= wide(F.lit(total_n)) * wide(F.col("d")))
    out = per.agg(F.count(F.lit(1)).alias("reps"), F.count_if(reach).alias("reach"), F.sum(_unless(F.col("d") != take, F.col("d"))).cast("long").alias("drawn_rows"))
    out = out.select("*", F.lit(total).cast("long").alias("observed_total"), F.lit(total_n).cast("long").alias("observed_n"))
    return out.select("reps", "observed_total", "observed_n", pct("observed_n", "observed_total").alias("observed_pct"),
                      "drawn_rows", "reach", round_half_up_ratio("reach", "reps", 4).alias("reach_share"))


def drawn_median(tagged: DataFrame, cohort_col: str, observed: str, population: str, id_col: str, value_col: str, reps: int = 1000) -> DataFrame:
    """How often the median of an equal-size random draw of rows from ``population`` reaches the median of ``observed``.

    ``value_col`` is integral; its nulls take no part.  The draws are those of
    ``drawn_rate``.  A replicate's median lies near the population's: values
    farther off than 8 standard deviations are only counted as smaller or larger,
    and a median among these is an error, no result.
    """
    side = F.when(F.col(cohort_col) == observed, 0).when(F.col(cohort_col) == population, 1)
    rows = tagged.select(side.alias("side"), F.col(id_col).alias("__id"), F.col(value_col).cast("long").alias("__v")).filter("side IS NOT NULL AND __v IS NOT NULL")
    rows = written(rows.groupBy("side", F.when(F.col("side") == 1, F.col("__id")).alias("__id"), "__v").agg(F.count(F.lit(1)).alias("__c")), "drawn-rows")
    own, total = rows.agg(*[F.coalesce(F.sum(F.when(F.col("side") == i, F.col("__c"))), F.lit(0)).cast("long") for i in (0, 1)]).first()
    take, pop = min(own, total), rows.filter("side = 1").drop("side")
    spread = _spread(pop)
    room = total * (4 * math.sqrt(spread[1] / max(take, 1)) + 16 * spread[2] / max(take, 1))
    wanted = {(0, k) for k in {(own + 1) // 2, own // 2 + 1} if own} | {(1, min(max(int(total / 2 + x), 1), total)) for x in (-room, room) if total}
    asked = tagged.sparkSession.createDataFrame(sorted(wanted), "side int, k long")
    found = sorted((s, v) for s, v in values_at_ranks(counted(rows, ["side"], "__c"), asked, ["side"]).select("side", "value").collect())
    a, b = ([v for s, v in found if s == i] for i in (0, 1))
    middle = float(a[0] + a[-1]) * 0.5 if own else None
    low, high = (b[0], b[-1]) if total else (0, 0)
    at = F.when(F.col("__v") < low, -1).when(F.col("__v") > high, 1).otherwise(0)
    near = pop.withColumn("at", at).withColumn("__v", F.when(F.col("at") == 0, F.col("__v")))
    near = near.groupBy("__id", "at", "__v").agg(F.sum("__c").alias("__c"))
    taken = _taken(near, ["at", "__v"], take, reps, spread)
    upto = F.sum("n").over(Window.partitionBy("rep").orderBy("at", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = taken.withColumn("upto", upto)
    holds = reduce(lambda x, y: x | y, [(F.col("upto") >= k) & (F.col("upto") - F.col("n") < k) for k in {(take + 1) // 2, take // 2 + 1}])
    value = F.when(holds, _unless(F.col("at") != 0, F.col("__v"))).cast("decimal(38,0)")
    per = placed.groupBy("rep").agg(F.sum("n").alias("d"), ((F.min(value) + F.max(value)).cast("double") * F.lit(0.5)).alias("m"))
    reach = F.count_if(F.col("m") >= F.lit(middle).cast("double"))
    out = per.agg(F.count(F.lit(1)).alias("reps"), F.sum(_unless(F.col("d") != take, F.col("d"))).cast("long").alias("drawn_rows"), reach.alias("reach"))
    out = out.select("reps", F.lit(own).cast("long").alias("observed_n"), F.lit(middle).cast("double").alias("observed_median"), "drawn_rows", "reach")
    return out.withColumn("reach_share", round_half_up_ratio("reach", "reps", 4))


def bootstrap_rate(tagged: DataFrame, cohort_col: str, observed: str, population: str, flag: Column, reps: int = 1000) -> DataFrame:
    """How often a random draw from cohort ``population`` reaches the flag rate of cohort ``observed``.

    Each replicate takes exactly as many rows as ``observed`` has (all, if there
    are fewer), without replacement; the number of hits among them is drawn from
    its exact law.  Rates are compared as DECIMAL products.
    """
    is_in, is_out, hit = F.col(cohort_col) == observed, F.col(cohort_col) == population, F.coalesce(flag, F.lit(False))
    size = tagged.agg(F.count_if(is_in).alias("observed_total"), F.count_if(is_in & hit).alias("observed_n"),
                      F.count_if(is_out).alias("total"), F.count_if(is_out & hit).alias("hits"))
    s = size.select(F.struct("*", F.least("observed_total", "total").alias("take")).alias("s")).scalar()
    drawn = _replicates(tagged, reps).withColumn("s", s).select("rep", "s.*")
    drawn = drawn.withColumn("k", hypergeometric("total", "hits", "take", "'rate'", "rep"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    reach = (F.col("take") > 0) & (wide("k") * wide("observed_total") >= wide("observed_n") * wide("take"))
    out = drawn.agg(F.count(F.lit(1)).alias("reps"), F.count_if(reach).alias("reach"), F.sum("take").cast("bigint").alias("drawn_rows"),
                    F.max("observed_total").alias("observed_total"), F.max("observed_n").alias("observed_n"))
    return out.select("reps", "observed_total", "observed_n", pct("observed_n", "observed_total").alias("observed_pct"),
                      "drawn_rows", "reach", round_half_up_ratio("reach", "reps", 4).alias("reach_share"))


def _middles(n: int) -> Column:
    """The ranks (from 1) that the median of ``n`` values needs: one if ``n`` is odd, else two."""
    return F.array(*[F.lit(k).cast("long") for k in sorted({(n + 1) // 2, n // 2 + 1})])


def _median_of(picked: DataFrame, *by: str) -> DataFrame:
    """``by, m`` from one or two middle ``value`` of each."""
    both = picked.groupBy(*by).agg(F.min("value").cast("decimal(38,0)").alias("a"), F.max("value").cast("decimal(38,0)").alias("b"))
    return both.select(*by, ((F.col("a") + F.col("b")).cast("double") * F.lit(0.5)).alias("m"))


def median_baseline(tagged: DataFrame, cohort_col: str, observed: str, population: str, value_col: str, reps: int = 1000) -> DataFrame:
    """How often the median of an equal-size random draw from ``population`` reaches the median of ``observed``.

    ``value_col`` is integral; its nulls take no part.  The values of both cohorts
    are counted once.  Each replicate draws the population ranks of its middle
    values (one or two, of one sample), and all ranks are looked up together.
    Without rows in one of the cohorts there is no replicate.
    """
    side = F.when(F.col(cohort_col) == observed, 0).when(F.col(cohort_col) == population, 1)
    known = tagged.select(side.alias("side"), F.col(value_col).cast("long").alias("__v")).filter(F.col("side").isNotNull() & F.col("__v").isNotNull())
    values = counted(known, ["side"])
    n, total = values.agg(*[F.coalesce(F.sum(F.when(F.col("side") == i, F.col("__n"))), F.lit(0)).cast("long") for i in (0, 1)]).first()
    take = min(n, total)
    own = _replicates(tagged, 1).filter(F.lit(n > 0)).select(F.lit(0).alias("side"), F.lit(0).cast("long").alias("rep"), F.explode(_middles(n)).alias("k"))
    drawn = _replicates(tagged, reps).filter(F.lit(take > 0)).select(
        F.lit(1).alias("side"), "rep", F.explode(sample_middle_ranks(f"{total}L", f"{take}L", False, "'median'", "rep")).alias("k"))
    medians = _median_of(values_at_ranks(values, own.unionByName(drawn), ["side"]), "side", "rep")
    both = medians.agg(F.max(F.when(F.col("rep") == 0, F.col("m"))).alias("observed_median"), F.collect_list(F.when(F.col("rep") > 0, F.col("m"))).alias("draws"))
    reached = F.size(F.filter("draws", lambda m: m >= F.col("observed_median"))).cast("bigint")
    done = F.size("draws").cast("bigint")
    out = both.select(done.alias("reps"), F.lit(n).cast("long").alias("observed_n"), "observed_median", (done * take).alias("drawn_rows"), reached.alias("reach"))
    return out.withColumn("reach_share", round_half_up_ratio("reach", "reps", 4))


def bootstrap_median(cell: DataFrame, value_col: str, reps: int = 200, ci: tuple[float, float] = (0.025, 0.975)) -> DataFrame:
    """Bootstrap interval of one cell's median: each replicate draws as many rows as the cell has, with replacement.

    ``value_col`` is integral; its nulls take no part.  The values are counted
    once; a replicate splits its draws binomially down a tree of rank ranges to
    the ranks of its middle values, and all ranks are looked up together.
    """
    values = counted(cell.select(F.col(value_col).cast("long").alias("__v")).filter("__v IS NOT NULL"), [])
    n = values.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long")).first()[0]
    own = _replicates(cell, 1).select(F.lit(0).cast("long").alias("rep"), F.explode(_middles(n)).alias("k"))
    drawn = _replicates(cell, reps).select("rep", F.explode(sample_middle_ranks(f"{n}L", f"{n}L", True, "'cell'", "rep")).alias("k"))
    medians = _median_of(values_at_ranks(values, own.unionByName(drawn).filter(F.lit(n > 0)), []), "rep")
    own_row, draw = F.col("rep") == 0, F.col("rep") > 0
    return medians.agg(F.max(F.when(own_row, F.col("m"))).alias("median"), F.lit(n).cast("long").alias("n"), F.count_if(draw).alias("reps"),
                       F.percentile(F.when(draw, F.col("m")), ci[0]).alias("ci_low"),
                       F.percentile(F.when(draw, F.col("m")), ci[1]).alias("ci_high"))
