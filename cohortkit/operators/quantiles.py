"""Exact order statistics without gathering a group into one task.

``percentile`` / ``median`` keep a value -> count map per group, so one hot
group with many distinct values must be merged in a single task.  Here the
k-th smallest value of each group is found by *radix selection*.  Values are
counted once per group and written to the shared folder (one job, with
map-side partial aggregation); every pass then adds up the counts of the
group's remaining candidates in at most 65,536 equal-width buckets, picks
the bucket holding rank k from that bounded histogram, and narrows the
interval to it.  Four passes resolve any 64-bit range; they read only the
counted values and form one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.session import scratch_path

BUCKETS = 1 << 16
PASSES = 4


def counted(values: DataFrame, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """``(keys, __v, __n)`` from ``(keys, __v[, weight])``, written to the shared folder and read back."""
    n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    return written(values.groupBy(*keys, "__v").agg(n.alias("__n")), "counted-values")


def written(table: DataFrame, name: str) -> DataFrame:
    """``table``, written to the shared folder and read back: what reads it several times computes it once."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _same(left: str, right: str, keys: Sequence[str]):
    """Null-safe equality on ``keys`` between two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys], F.lit(True))


def _refine(values: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """One radix pass: narrow every target to the bucket holding its rank.

    Differences are taken in DECIMAL, so intervals may span the whole range
    of a 64-bit integer.
    """
    wide = "CAST({} AS DECIMAL(38, 0))"
    st = state.withColumn("__w", F.expr(f"CAST(({wide.format('__hi')} - __lo) div {BUCKETS} + 1 AS BIGINT)"))
    carry = [c for c in state.columns if c not in keys + ["which", "k", "__lo", "__hi"]]
    j = (values.alias("l").join(st.alias("r"), _same("l", "r", keys))
         .select(*[F.col(f"r.{k}").alias(k) for k in keys], "r.which", "r.k", "l.__v", "l.__n", "r.__lo", "r.__w",
                 "r.__hi", *[F.col(f"r.{c}").alias(c) for c in carry])
         .filter(F.col("__v").between(F.col("__lo"), F.col("__hi"))))
    # k, __lo, __hi, __w (and carried columns) depend only on (keys, which):
    # grouping by them keeps each pass a single reference to the previous state
    hist = (j.withColumn("__b", F.expr(f"CAST(({wide.format('__v')} - __lo) div __w AS BIGINT)"))
            .groupBy(*keys, "which", "k", "__lo", "__hi", "__w", *carry, "__b").agg(F.sum("__n").cast("long").alias("__c")))
    w = (Window.partitionBy(*keys, "which").orderBy("__b")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = hist.withColumn("__cum", F.sum("__c").over(w))  # <= 65,536 rows per target
    before = F.col("__cum") - F.col("__c")
    chosen = h.filter((before < F.col("k")) & (F.col("k") <= F.col("__cum")))
    low = f"{wide.format('__lo')} + {wide.format('__b')} * __w"
    return chosen.select(*keys, "which", (F.col("k") - before).alias("k"), F.expr(f"CAST({low} AS BIGINT)").alias("__lo"),
                         F.expr(f"CAST(least({wide.format('__hi')}, {low} + __w - 1) AS BIGINT)").alias("__hi"), *carry)


def kth_smallest(values: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Resolve ``(keys, which, k)`` targets to the k-th smallest ``__v`` of each group.

    ``values``: ``(keys, __v bigint, __n bigint)``, each value counted ``__n``
    times; ``targets``: ``(keys, which, k, __lo, __hi, ...)`` with
    ``__lo``/``__hi`` the group's min/max; extra columns are carried along.
    Returns the targets with ``value``.
    """
    state = targets
    for _ in range(PASSES):
        state = _refine(values, state, list(keys))
    return state.withColumn("value", F.col("__lo")).drop("k", "__lo", "__hi")


def median_of_counts(values: DataFrame, keys: Sequence[str], out: str = "median", count_col: str = "n") -> DataFrame:
    """Interpolated median per group of a ``counted`` table."""
    keys = list(keys)
    stats = values.groupBy(*keys).agg(F.sum("__n").cast("long").alias(count_col), F.min("__v").alias("__lo"),
                                      F.max("__v").alias("__hi"))
    # 1-based positions of the two middle values; equal when n is odd
    pos = F.array(F.struct(F.lit(0).alias("which"), F.expr(f"({count_col} - 1) div 2 + 1").alias("k")),
                  F.struct(F.lit(1).alias("which"), F.expr(f"{count_col} div 2 + 1").alias("k")))
    targets = (stats.select(*keys, count_col, "__lo", "__hi", F.explode(pos).alias("t"))
               .select(*keys, "t.which", "t.k", "__lo", "__hi", count_col))
    picked = kth_smallest(values, targets, keys)
    both = picked.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("value"))).alias("__a"),
                                     F.max(F.when(F.col("which") == 1, F.col("value"))).alias("__b"),
                                     F.max(count_col).alias(count_col))
    a, b = F.col("__a").cast("decimal(38,0)"), F.col("__b").cast("decimal(38,0)")
    return both.select(*keys, ((a + b).cast("double") * F.lit(0.5)).alias(out), count_col)


def values_at_ranks(values: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``targets`` (``keys``, ``k`` and any other columns) with ``value``, the ``k``-th smallest of its group (``k`` from 1).

    ``values`` is a ``counted`` table.  All targets are resolved in one search:
    each pass counts the rows of 65,536 ranges within the ranges still wanted and
    places every rank by one ordered window over these counts.  The first pass
    takes the leading bits that tell the smallest value from the largest, so
    narrow data needs fewer passes; one row (both ends) is read for that.
    """
    keys = list(keys)
    low, high = values.agg(F.min("__v"), F.max("__v")).first()
    spare = 0 if low is None else max(0, (high - low).bit_length() - 16)
    names, outer = targets.columns, None
    state = written(targets, "wanted-ranks").withColumn("__k", F.col("k"))
    for shift in [*range(spare, 0, -16), 0]:
        inside = values.withColumn("__node", F.shiftright("__v", shift))
        parent = []
        if outer is not None:
            parent = ["__parent"]
            inside = inside.withColumn("__parent", F.shiftright("__v", outer))
            wanted = state.select(*[F.col(c).alias(f"{c}__w") for c in [*keys, *parent]]).distinct()
            inside = inside.join(wanted, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}__w")) for c in [*keys, *parent]]), "left_semi")
        ranges = inside.groupBy(*keys, *parent, "__node").agg(F.sum("__n").cast("long").alias("__c"))
        up_to = Window.partitionBy(*keys, *parent).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum("__c").over(Window.partitionBy(*keys, *parent).orderBy("__node").rowsBetween(Window.unboundedPreceding, -1))
        starts = ranges.select(*keys, *parent, F.struct(F.coalesce(before, F.lit(0)).alias("before"), "__node").alias("__r")).withColumn("__at", F.col("__r.before") + 1)
        asked = state.select(*keys, *parent, F.struct(*names, "__k").alias("__t"), F.col("__k").alias("__at"), F.lit(1).alias("__kind"))
        mixed = starts.withColumn("__kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
        placed = mixed.withColumn("__r", F.max("__r").over(up_to)).filter("__kind = 1")
        state = placed.select(*[F.col(f"__t.{c}").alias(c) for c in names], (F.col("__t.__k") - F.col("__r.before")).alias("__k"), F.col("__r.__node").alias("__parent"))
        outer = shift
    return state.select(*names, F.col("__parent").alias("value"))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", count_col: str = "n") -> DataFrame:
    """Interpolated median per group (same as ``median``) of an integral column.

    Runs one job that writes the counted values; scale money to cents (or
    any fixed point) before calling.
    """
    data = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("long").alias("__v"))
    return median_of_counts(counted(data, list(keys)), keys, out, count_col)
