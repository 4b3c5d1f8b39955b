"""Integrity checks: uniqueness, all-null rows, reconciliation, orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.numeric import pct
from cohortkit.operators.joins import combine_scalars


def _check(name: str, agg: DataFrame, observed: str, passed) -> DataFrame:
    return agg.select(F.lit(name).alias("check"), passed.alias("passed"),
                      F.col(observed).cast("bigint").alias("observed"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M1: number of key tuples occurring more than once (0 passes)."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
           .agg(F.count_if(F.col("c") > 1).alias("dups")))
    return _check("no_duplicate_keys", dup, "dups", F.col("dups") == 0)


def all_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M2: rows whose listed measures are all NULL (0 passes)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    agg = df.agg(F.count_if(cond).alias("bad"))
    return _check("no_all_null_measures", agg, "bad", F.col("bad") == 0)


def reconcile(facts: DataFrame, tagged: DataFrame, key: str, cohort_col: str = "cohort") -> DataFrame:
    """M3: facts = sum of cohort sizes + rows with a NULL key; ``observed`` is the gap."""
    a = facts.agg(F.count(F.lit(1)).alias("facts"), F.count_if(F.col(key).isNull()).alias("null_keys"))
    b = tagged.agg(F.count(F.lit(1)).alias("tagged"))
    gap = combine_scalars(a, b).withColumn("gap", F.col("facts") - F.col("tagged") - F.col("null_keys"))
    return _check("cohorts_reconcile", gap, "gap", F.col("gap") == 0)


def orphans(bridge: DataFrame, facts: DataFrame, bridge_key: str, fact_key: str) -> DataFrame:
    """F8: bridge rows whose key is absent from the facts, with their share (a NULL key is absent).

    One scan of the bridge: its rows are counted per key, the counts meet the
    distinct fact keys, and both totals come from one aggregate.
    """
    counts = bridge.groupBy(F.col(bridge_key).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    known = facts.filter(F.col(fact_key).isNotNull()).select(F.col(fact_key).alias("__k")).distinct()
    j = counts.join(known, F.col("__b") == F.col("__k"), "left")
    return (j.agg(F.coalesce(F.sum(F.when(F.col("__k").isNull(), F.col("__n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
                  F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("bridge_rows"))
            .withColumn("orphan_pct", pct("orphan_rows", "bridge_rows")))
