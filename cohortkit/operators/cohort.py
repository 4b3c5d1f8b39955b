"""Cohort definition, tagging and join diagnostics.

A *member set* is the distinct, non-null keys of an event table that carry
at least one non-null measure.  *Tagging* labels every fact row by whether
its key is in the member set (rows with a NULL key belong to neither
cohort).  The member set is never force-broadcast: it can grow with the
data, so Spark's size estimate and AQE's runtime statistics decide.

Measures that only count rows should tag *counts* (``key_counts``): the
facts are first grouped by key and category, with map-side partial
aggregation, so a hot key is a few rows before any join.  Queries that
return fact rows tag the rows; a hot key is then split by AQE, which the
layout of the member set allows (``joins.per_key``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.numeric import pct
from cohortkit.operators import sketches
from cohortkit.operators.joins import combine_scalars, per_key

IN_LABEL, OUT_LABEL = "flagged", "rest"


def members(events: DataFrame, key: str, measures: Sequence[str] = (), where: Column | None = None,
            out: str | None = None) -> DataFrame:
    """Distinct non-null ``key`` of rows with at least one non-null measure."""
    cond = F.col(key).isNotNull()
    if measures:
        any_measure = F.lit(False)
        for m in measures:
            any_measure = any_measure | F.col(m).isNotNull()
        cond = cond & any_measure
    if where is not None:
        cond = cond & where
    return per_key(events.filter(cond).select(F.col(key).alias(out or key)), out or key)


def key_counts(facts: DataFrame, key: str, by: Mapping[str, Column] | None = None, n: str = "n") -> DataFrame:
    """``(key, *by, n)``: fact rows per non-null key and category, for measures that count rows."""
    cols = [c.alias(name) for name, c in (by or {}).items()]
    return facts.filter(F.col(key).isNotNull()).groupBy(F.col(key), *cols).agg(F.count(F.lit(1)).alias(n))


def tag(facts: DataFrame, member_keys: DataFrame, fact_key: str, member_key: str | None = None,
        labels: tuple[str, str] = (IN_LABEL, OUT_LABEL), cohort_col: str = "cohort") -> DataFrame:
    """Facts with a cohort label; NULL-key facts are removed.

    ``member_keys`` must be distinct on its key (``members`` guarantees it),
    so the left join never fans out.
    """
    member_key = member_key or fact_key
    m = member_keys.select(F.col(member_key).alias("__member_key")).withColumn("__hit", F.lit(True))
    joined = facts.filter(F.col(fact_key).isNotNull()).join(m, F.col(fact_key) == F.col("__member_key"), "left")
    return (joined.withColumn(cohort_col, F.when(F.col("__hit"), F.lit(labels[0])).otherwise(F.lit(labels[1])))
            .drop("__member_key", "__hit"))


def tag_prefiltered(facts: DataFrame, member_keys: DataFrame, fact_key: str, member_key: str | None = None,
                    labels: tuple[str, str] = (IN_LABEL, OUT_LABEL), cohort_col: str = "cohort", log2_bits: int = 20) -> DataFrame:
    """``tag`` for a cohort that is a small part of very many facts: only facts that may be members are joined.

    A bit array of the member keys (``sketches.key_filter``, 2 ** ``log2_bits``
    bits) tells which facts cannot be members; they get their label where they
    are scanned and are not shuffled.  False positives are settled by the join,
    so the result is that of ``tag`` for any size of the filter.
    """
    member_key = member_key or fact_key
    maybe = sketches.may_hold(sketches.key_filter(member_keys, member_key, log2_bits).scalar(), F.col(fact_key), log2_bits)
    known = facts.filter(F.col(fact_key).isNotNull())
    joined = tag(known.filter(maybe), member_keys, fact_key, member_key, labels, cohort_col)
    return joined.unionByName(known.filter(~maybe).withColumn(cohort_col, F.lit(labels[1])))


def semi_join_count(facts: DataFrame, member_keys: DataFrame, fact_key: str,
                    member_key: str | None = None) -> DataFrame:
    """Number of fact rows whose key is a member (``IN (SELECT DISTINCT ...)``).

    The facts are counted per key first, so a hot key is one row in the join.
    """
    member_key = member_key or fact_key
    spark = facts.sparkSession
    # SQL over named relations (``{facts}``/``{members}`` are bound DataFrames, no
    # global view is created); ``IN (subquery)`` is planned as a left semi join.
    return spark.sql(
        f"SELECT COALESCE(SUM(n), 0) AS matched_facts FROM {{facts}} "
        f"WHERE `{fact_key}` IN (SELECT `{member_key}` FROM {{members}})",
        facts=key_counts(facts, fact_key), members=member_keys)


def join_diagnostic(facts: DataFrame, events: DataFrame, fact_key: str, event_key: str) -> DataFrame:
    """Join-viability diagnostic as ``(metric, value)`` strings.

    distinct member keys, distinct fact keys, matched keys, key hit %,
    fact rows, matched fact rows, matched share %.  Zero-safe: an empty
    side gives 0.0 %, like the reference.  Three small aggregates and one
    key-level join; no fact row is shuffled by key except through partial
    aggregation.
    """
    ev = events.filter(F.col(event_key).isNotNull()).select(F.col(event_key).alias("k")).distinct()
    # Fact keys with their row counts: one partial-aggregated shuffle of the facts.
    fk = (facts.filter(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("k"))
          .agg(F.count(F.lit(1)).alias("rows")))
    hits = ev.join(fk, "k", "inner")
    row = combine_scalars(
        ev.agg(F.count(F.lit(1)).alias("distinct_member_keys")),
        fk.agg(F.count(F.lit(1)).alias("distinct_fact_keys")),
        facts.agg(F.count(F.lit(1)).alias("total_facts")),
        hits.agg(F.count(F.lit(1)).alias("matched_keys"),
                 F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("matched_facts")))
    row = (row.withColumn("key_hit_pct", F.coalesce(pct("matched_keys", "distinct_member_keys"), F.lit(0.0)))
              .withColumn("fact_share_pct", F.coalesce(pct("matched_facts", "total_facts"), F.lit(0.0))))
    order = ["distinct_member_keys", "distinct_fact_keys", "matched_keys", "key_hit_pct",
             "total_facts", "matched_facts", "fact_share_pct"]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(n).alias("metric"),
                 F.col(n).cast("string").alias("value")) for i, n in enumerate(order)])).alias("m")
    return row.select(stacked).select("m.position", "m.metric", "m.value")


def unmatched(events: DataFrame, facts: DataFrame, event_key: str, fact_key: str,
              order_by: Sequence[Column], k: int = 20) -> DataFrame:
    """Event rows whose key has no fact (anti join), top ``k`` by ``order_by``."""
    fk = per_key(facts.filter(F.col(fact_key).isNotNull()).select(F.col(fact_key).alias("__k")), "__k")
    ev = events.filter(F.col(event_key).isNotNull())
    return ev.join(fk, F.col(event_key) == F.col("__k"), "left_anti").orderBy(*order_by).limit(k)


def recency_tag(facts: DataFrame, events: DataFrame, fact_key: str, event_key: str, ts_col: str,
                cutoff: str, labels: tuple[str, str, str] = ("recent", "lapsed", "none"),
                cohort_col: str = "cohort") -> DataFrame:
    """Three-way cohort on the latest event per key: at/after ``cutoff``, before it, or no event."""
    dated = events.filter(F.col(event_key).isNotNull()).select(F.col(event_key).alias("__k"), ts_col)
    last = per_key(dated, "__k", F.max(ts_col).alias("__last"))
    joined = facts.filter(F.col(fact_key).isNotNull()).join(last, F.col(fact_key) == F.col("__k"), "left")
    label = (F.when(F.col("__last").isNull(), F.lit(labels[2]))
             .when(F.col("__last") >= F.lit(cutoff).cast(dict(events.dtypes)[ts_col]), F.lit(labels[0]))
             .otherwise(F.lit(labels[1])))
    return joined.withColumn(cohort_col, label).drop("__k", "__last")


def both_sided_strata(counts: DataFrame, stratum: str, cohort_col: str = "cohort") -> DataFrame:
    """Keep only strata in which both cohorts occur (window over the small counts table)."""
    w = Window.partitionBy(stratum)
    return (counts.withColumn("__lo", F.min(cohort_col).over(w)).withColumn("__hi", F.max(cohort_col).over(w))
            .filter(F.col("__lo") != F.col("__hi")).drop("__lo", "__hi"))
