"""Derived frames that map the reference's roles onto the test tables.

Role map: ``orders`` are the facts (entity ``o_custkey``, level
``o_orderpriority``, measure ``o_totalprice``, flag ``o_orderstatus='F'``),
``events`` with ``event_type='error' AND value > 8`` define the cohort,
``lineitem``/``part`` are the bridge and lookup, ``customer``/``nation`` the
region.  Dirty text columns (names with legal suffixes, locations, flags,
bounds) are derived deterministically from the keys so that the SQL oracle
can rebuild them exactly.  All of it is lazy and grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators import cohort, rules
from cohortkit.sources.files import load

# --- fixed values of the test-role mapping ---------------------------------
# Legal-form suffixes appended to customer names, picked by c_custkey % 8;
# slot 6 is a blank name and slot 7 a missing one.
NAME_SUFFIXES = [" Inc", " Corp.", ", LLC", " Limited", " corporation", " Ltd. "]
PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
TYPE_SET = ["ECONOMY", "SMALL"]
BOUNDS = (10000.0, 1000000.0)
COHORT_EVENT = "error"
COHORT_MIN_VALUE = 8.0
# Series roles: order status -> 6-digit industry code; priority -> data element.
STATUS_INDUSTRY = {"F": "000000", "O": "510000", "P": "520000"}
# ---------------------------------------------------------------------------

def cohort_events(spark: SparkSession, base: str) -> DataFrame:
    """Rows that define the cohort (the reference's layoff events)."""
    ev = load(spark, base, "events")
    return ev.filter((F.col("event_type") == COHORT_EVENT) & (F.col("value") > COHORT_MIN_VALUE))


def member_keys(spark: SparkSession, base: str) -> DataFrame:
    return cohort.members(cohort_events(spark, base), "user_id", measures=["value"])


def tagged_orders(spark: SparkSession, base: str, cols: list[str] | None = None) -> DataFrame:
    """Orders with ``cohort`` in {flagged, rest}; column pruning reaches the scan."""
    orders = load(spark, base, "orders")
    if cols:
        orders = orders.select(*sorted(set(cols) | {"o_custkey"}))
    return cohort.tag(orders, member_keys(spark, base), "o_custkey", "user_id")


def tagged_counts(spark: SparkSession, base: str, **by) -> DataFrame:
    """``(o_custkey, *by, n, cohort)``: orders counted per customer and category, then tagged."""
    counts = cohort.key_counts(load(spark, base, "orders"), "o_custkey", by)
    return cohort.tag(counts, member_keys(spark, base), "o_custkey", "user_id")


def dirty_customers(spark: SparkSession, base: str) -> DataFrame:
    """Customers with a dirty name and a ``"nation, region"`` location (every third comma-less)."""
    c = load(spark, base, "customer")
    nation = load(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load(spark, base, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    geo = nation.join(region, "n_regionkey", "left")
    slot = F.col("c_custkey") % 8
    name = F.lit(None).cast("string")
    for i in reversed(range(len(NAME_SUFFIXES))):
        name = F.when(slot == i, F.concat(F.col("c_name"), F.lit(NAME_SUFFIXES[i]))).otherwise(name)
    name = F.when(slot == 6, F.lit("")).otherwise(name)
    loc = F.when(F.col("c_custkey") % 3 == 0, F.col("n_name")).otherwise(
        F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")))
    joined = c.join(geo.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left")
    return joined.select("c_custkey", "c_name", name.alias("dirty_name"), loc.alias("location"),
                         "c_nationkey", "c_mktsegment")


def dirty_orders(spark: SparkSession, base: str) -> DataFrame:
    """Orders with nullable range bounds, a bounded measure, two sparse measures and flag text."""
    o = load(spark, base, "orders")
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    none_d = F.lit(None).cast("double")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(k % 7 == 0, none_d).otherwise(p * F.lit(0.9)).alias("lo"),
        F.when(k % 11 == 0, none_d).when(k % 5 == 0, p * F.lit(0.5)).otherwise(p * F.lit(1.1)).alias("hi"),
        F.when(k % 13 == 0, none_d).otherwise(p).alias("val"),
        F.when(k % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("a"),
        F.when(k % 4 == 0, none_d).otherwise(p).alias("b"),
        F.when(k % 5 == 0, F.lit("1")).when(k % 5 == 1, F.lit("1.0")).when(k % 5 == 2, F.lit("0"))
         .when(k % 5 == 3, F.lit("")).otherwise(F.lit(None).cast("string")).alias("flag_text"),
    )


def order_rules() -> list[rules.Rule]:
    """The reference's postings/layoffs rules, in order, on the dirty orders."""
    return [rules.Rule("inverted_range", rules.inverted_range("lo", "hi")),
            rules.Rule("out_of_bounds", rules.out_of_bounds("val", *BOUNDS)),
            rules.Rule("all_measures_null", rules.all_null(["a", "b"]))]


def _tenths_text(k, n):
    """``100*k/n`` rounded half-up to one decimal, as text (exact integer arithmetic)."""
    v10 = f"((2000 * {k} + {n}) div (2 * {n}))"
    return F.concat(F.expr(f"{v10} div 10").cast("string"), F.lit("."), F.expr(f"{v10} % 10").cast("string"))


def raw_series(spark: SparkSession, base: str) -> DataFrame:
    """Coded monthly series derived from orders: ``(series_id, year, period, value)`` text.

    For each month and order status: share of urgent (JO), high (HI) and low
    (LD) priority orders and of orders above 250,000 (QU, an element code
    with no label).  Each year also gets an ``M13`` annual row.
    """
    o = load(spark, base, "orders").select(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_orderstatus",
        "o_orderpriority", "o_totalprice")
    counts = [F.count(F.lit(1)).alias("n"),
              F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("jo"),
              F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("hi"),
              F.count_if(F.col("o_orderpriority") == "5-LOW").alias("ld"),
              F.count_if(F.col("o_totalprice") > 250000).alias("qu")]
    by_month = o.groupBy("y", "m", "o_orderstatus").agg(*counts)
    monthly = by_month.withColumn(
        "period", F.concat(F.lit("M"), F.lpad(F.col("m").cast("string"), 2, "0"))).drop("m")
    # the annual rows re-aggregate the (small) monthly counts: orders are scanned once
    annual = (by_month.groupBy("y", "o_orderstatus")
              .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", "jo", "hi", "ld", "qu")])
              .withColumn("period", F.lit("M13")))
    both = monthly.unionByName(annual)
    code = F.coalesce(F.try_element_at(F.create_map(*[x for kv in STATUS_INDUSTRY.items() for x in map(F.lit, kv)]),
                                   F.col("o_orderstatus")), F.lit("999999"))
    elements = F.array(*[F.struct(F.lit(de).alias("de"), _tenths_text(c, "n").alias("value"))
                         for de, c in (("JO", "jo"), ("HI", "hi"), ("LD", "ld"), ("QU", "qu"))])
    return (both.select("y", "period", code.alias("code"), F.explode(elements).alias("e"))
            .select(F.concat(F.lit("JTS"), F.col("code"), F.lit("000000000"), F.col("e.de"), F.lit("R"))
                    .alias("series_id"),
                    F.col("y").cast("string").alias("year"), "period", F.col("e.value").alias("value")))


def clean_series(spark: SparkSession, base: str) -> DataFrame:
    from cohortkit.operators import series

    return series.decode(rules.apply_rules(raw_series(spark, base), series.series_rules()))
