"""Ordered cleaning rules with a single-pass drop audit.

A rule names a condition under which a row is dropped.  Rules are applied
in order; the audit counts every dropped row once, under the first rule it
fails, and reconciles ``raw = final + sum(dropped)`` in the same aggregate.
``write_clean`` gathers these counts while it writes the clean rows
(``DataFrame.observe``), so that table and audit cost one pass together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortkit.sources import sinks


@dataclass(frozen=True)
class Rule:
    name: str
    drop_when: Column  # NULL counts as "do not drop"

    def failed(self) -> Column:
        return F.coalesce(self.drop_when, F.lit(False))


# --- reusable rule conditions ---------------------------------------------
def inverted_range(lo: str, hi: str) -> Column:
    """Both bounds present and ``lo > hi`` (a NULL bound never drops a row)."""
    return F.col(lo).isNotNull() & F.col(hi).isNotNull() & (F.col(lo) > F.col(hi))


def out_of_bounds(col: str, lo: float, hi: float) -> Column:
    """Present and outside ``[lo, hi]`` (bounds inclusive; NULL is kept)."""
    return F.col(col).isNotNull() & ~F.col(col).between(lo, hi)


def all_null(cols: Sequence[str]) -> Column:
    """Every listed column is NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    return cond


def not_in(col: str, values: Sequence) -> Column:
    """Value outside a fixed keep-list (NULL dropped too)."""
    return ~F.coalesce(F.col(col).isin(list(values)), F.lit(False))


def equals(col: str, value) -> Column:
    """Sentinel value; a NULL is dropped as well (``col != v`` is not true for NULL)."""
    return ~F.coalesce(F.col(col) != F.lit(value), F.lit(False))
# ---------------------------------------------------------------------------


def first_failed_rule(rules: Sequence[Rule]) -> Column:
    """1-based index of the first rule a row fails, NULL when it passes all."""
    expr = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(rules, start=1))):
        expr = F.when(r.failed(), F.lit(i)).otherwise(expr)
    return expr


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passing every rule (one fused filter, pushed down where possible)."""
    keep = F.lit(True)
    for r in rules:
        keep = keep & ~r.failed()
    return df.filter(keep)


def _counts(failed: Column, rules: Sequence[Rule]) -> list[Column]:
    """Raw and final rows and the rows of each rule; ``failed`` is the index of the first rule a row fails."""
    return [F.count(F.lit(1)).alias("raw_row_count"), F.count_if(failed.isNull()).alias("final_row_count"),
            *[F.count_if(failed == i).alias(f"dropped_{r.name}") for i, r in enumerate(rules, start=1)]]


def audit(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """Drop counts per rule, raw/final rows and total dropped, in one pass.

    Output ``(dataset, metric, value)`` with ``value`` bigint; one row per
    rule even when it dropped nothing.
    """
    row = df.agg(*_counts(first_failed_rule(rules), rules)).withColumn("total_dropped", F.col("raw_row_count") - F.col("final_row_count"))
    names = [a for a in row.columns]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("value")) for n in names
    ])).alias("m")
    return row.select(stacked).select(F.lit(dataset).alias("dataset"), "m.metric", "m.value")


def clean_with_audit(df: DataFrame, rules: Sequence[Rule], dataset: str) -> tuple[DataFrame, DataFrame]:
    """``(clean, audit)``: both lazy; running both scans the input twice (``write_clean`` scans it once)."""
    return apply_rules(df, rules), audit(df, rules, dataset)


def observed_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """Rows passing every rule, and the rule counts that whatever runs them gathers on the way."""
    seen = Observation()
    failed = F.col("__failed")
    marked = df.withColumn("__failed", first_failed_rule(rules)).observe(seen, *_counts(failed, rules))
    return marked.filter(failed.isNull()).drop("__failed"), seen


def observed_rows(df: DataFrame, dataset: str, *seen: Observation) -> DataFrame:
    """``(dataset, metric, value)`` of observations, once the job that gathers them has run."""
    found = {k: v for o in seen for k, v in o.get.items()}
    if "raw_row_count" in found:
        found["total_dropped"] = found["raw_row_count"] - found["final_row_count"]
    return df.sparkSession.createDataFrame([(dataset, k, int(v or 0)) for k, v in found.items()], "dataset string, metric string, value bigint")


def write_clean(df: DataFrame, rules: Sequence[Rule], dataset: str, path: str, then: Callable[[DataFrame], DataFrame] | None = None,
                checks: Mapping[str, Column] | None = None, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write the rows passing every rule to ``path`` as Parquet; return the audit that the same pass gathered.

    ``then`` derives the written columns from the passing rows.  ``checks`` are
    conditions on written rows, counted as well (e.g. ``all_null`` of the
    measures: 0 after cleaning).  The counts belong to the tasks that were
    committed: a retried task counts once.  No aggregate, shuffle or second
    scan is added to the write.
    """
    clean, seen = observed_rules(df, rules)
    if then:
        clean = then(clean)
    also = []
    if checks:
        also = [Observation()]
        clean = clean.observe(also[0], *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    sinks.write_parquet(clean, path, partition_by)
    return observed_rows(df, dataset, seen, *also)
