"""Mergeable summaries: distinct counts, quantiles, frequent values and key filters.

Each is stored per partition of a table (a day, a load) and merged later, so a
table that grows is not read again: HyperLogLog sketches for distinct counts, KLL
sketches for quantiles, tables of hashed counts for frequent values, and bit
arrays that say which keys a table cannot hold.  Where an exact answer exists, the
summary leads to it or its error is stated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.operators.quantiles import written

#: Registers of a distinct-count sketch, as a power of two; the relative standard error is 1.04 / sqrt(2 ** HLL_BITS).
HLL_BITS = 12
HLL_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
#: Size of a quantile sketch; its rank error stays below KLL_ERROR with a probability of 99 %.
KLL_SIZE = 800
KLL_ERROR = 0.0045


# --- distinct counts ---------------------------------------------------------
def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by, column, sketch, nulls)``: one sketch of each column's values per group, for storing.

    Values are compared as text.  All columns are sketched in one scan with
    map-side partial sketches; no row is expanded.
    """
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS)).alias(f"__s{i}"), F.count_if(F.col(c).isNull()).alias(f"__n{i}")]
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__s{i}").alias("sketch"), F.col(f"__n{i}").alias("nulls"))
                                for i, c in enumerate(cols)])).alias("p")
    return df.groupBy(*by).agg(*aggs).select(*by, parts).select(*by, "p.*")


def merge_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored sketches merged into one per column (and group ``by``)."""
    return sketches.groupBy(*by, "column").agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("nulls").cast("bigint").alias("nulls"))


def estimate_distinct(sketches: DataFrame) -> DataFrame:
    """``estimate`` of merged sketches; NULL counts as one value, as in ``profile``.

    A sketch that was merged once more with itself is estimated from its registers
    alone, so the estimate does not depend on the order of the merges.
    """
    null = F.when(F.col("nulls") > 0, 1).otherwise(0)
    return sketches.withColumn("estimate", F.hll_sketch_estimate(F.hll_union("sketch", "sketch")) + null).drop("sketch", "nulls")


def distinct_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, exact)``: exact distinct counts, NULL as one value.

    Every column is read and grouped alone, with map-side partial aggregation,
    instead of expanding each row once for each column.
    """
    counts = [df.select(F.col(c).alias("v")).groupBy("v").agg(F.lit(1).alias("one")).agg(F.count(F.lit(1)).alias("exact")).select(F.lit(c).alias("column"), "exact")
              for c in cols]
    return reduce(DataFrame.unionByName, counts)


# --- quantiles ---------------------------------------------------------------
def quantile_sketches(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``(by, sketch, n)``: one quantile sketch of an integral column per group, for storing; NULL values take no part."""
    v = F.col(value).cast("bigint")
    return df.filter(v.isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_bigint(v, F.lit(KLL_SIZE)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merge_quantiles(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored quantile sketches merged per group ``by``."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", F.lit(KLL_SIZE)).alias("sketch"), F.sum("n").cast("bigint").alias("n"))


def estimate_quantile(sketches: DataFrame, q: float = 0.5, out: str = "estimate") -> DataFrame:
    """A value whose rank is within ``KLL_ERROR`` of ``q``."""
    return sketches.withColumn(out, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))).drop("sketch")


# --- frequent values ---------------------------------------------------------
def hashed_counts(df: DataFrame, col: str, hashes: int = 2, log2_buckets: int = 16) -> DataFrame:
    """``(hash, bucket, n)``: rows whose value falls into each bucket, for ``hashes`` unrelated hashes.

    At most ``hashes`` x 2 ** ``log2_buckets`` rows, from map-side counts; tables
    of partitions are merged by adding them up.  A bucket's count is an upper
    bound of the count of each of its values.
    """
    places = F.explode(F.array(*[F.struct(F.lit(i).alias("hash"), _bucket(F.col(col), i, log2_buckets).alias("bucket")) for i in range(hashes)])).alias("p")
    return df.select(places).groupBy("p.hash", "p.bucket").agg(F.count(F.lit(1)).alias("n"))


def _bucket(value: Column, i: int, log2_buckets: int) -> Column:
    return F.xxhash64(F.lit(i), value.cast("string")).bitwiseAND((1 << log2_buckets) - 1)


def frequent_values(df: DataFrame, col: str, k: int = 10, counts: DataFrame | None = None, hashes: int = 2, log2_buckets: int = 16) -> DataFrame:
    """The exact ``k`` most frequent values as ``(column, value, n, rank)``, like ``profile.top_values``.

    1. ``counts`` (``hashed_counts``; merged stored ones, or made here) bounds every
       value's count from above.
    2. The values in the fullest buckets are counted exactly; the ``k``-th of these
       counts bounds the answer from below.
    3. Only values all of whose buckets reach that bound can be in the answer;
       their rows alone are grouped.

    So a column with very many values is not grouped as a whole, unless its ``k``-th
    value is about as rare as all others.  NULL is a value; ties go to the smaller
    value, NULL first.  The lists of buckets have at most 2 ** ``log2_buckets`` rows.
    """
    rows = df.select(F.col(col).cast("string").alias("value"))
    table = written((counts if counts is not None else hashed_counts(df, col, hashes, log2_buckets)).groupBy("hash", "bucket").agg(F.sum("n").alias("n")), "hashed-counts")
    full = table.filter("hash = 0").orderBy(F.desc("n"), "bucket").limit(4 * k).select(F.col("bucket").alias("__b"))
    seeds = rows.join(F.broadcast(full), _bucket(F.col("value"), 0, log2_buckets) == F.col("__b"), "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ranked = seeds.orderBy(F.desc("n")).limit(k).agg(F.min("n").alias("low"), F.count(F.lit(1)).alias("found"))
    least = ranked.select(F.when(F.col("found") == k, F.col("low")).otherwise(1)).first()[0]  # fewer than k values: all of them
    wanted = rows
    for i in range(hashes):
        heavy = table.filter((F.col("hash") == i) & (F.col("n") >= least)).select(F.col("bucket").alias("__b"))
        wanted = wanted.join(F.broadcast(heavy), _bucket(F.col("value"), i, log2_buckets) == F.col("__b"), "left_semi")
    top = wanted.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.asc_nulls_first("value"))
    first = top.orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(k)
    return first.withColumn("rank", F.row_number().over(w)).select(F.lit(col).alias("column"), "value", "n", "rank")


# --- key filters -------------------------------------------------------------
def _places(key: Column, log2_bits: int) -> list[Column]:
    h = F.xxhash64(key)
    return [F.shiftrightunsigned(h, s).bitwiseAND((1 << log2_bits) - 1) for s in (0, 32)]


def key_filter(keys: DataFrame, key: str, log2_bits: int = 20) -> DataFrame:
    """One row ``(bits array<bigint>)`` of 2 ** ``log2_bits`` bits with two bits set for every key.

    Bits are joined in map-side aggregates of at most 2 ** (``log2_bits`` - 6)
    words; filters of partitions are merged by ``bit_or`` word by word.
    """
    words = 1 << (log2_bits - 6)
    place = keys.filter(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), log2_bits))).alias("p"))
    mask = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
    held = place.select(F.shiftright("p", 6).alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    every = keys.sparkSession.range(words).select(F.col("id").alias("word")).join(held, "word", "left")
    return every.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")))).alias("w")).select(
        F.col("w.mask").alias("bits"))


def may_hold(bits: Column, key: Column, log2_bits: int = 20) -> Column:
    """False only for keys that the filtered table does not hold; ``bits`` is ``key_filter(..).scalar()``."""
    def on(p: Column) -> Column:
        word = F.get(bits, F.shiftright(p, 6).cast("int"))
        return F.call_function("shiftright", word, p.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    one, two = _places(key, log2_bits)
    return F.coalesce(on(one) & on(two), F.lit(False))
