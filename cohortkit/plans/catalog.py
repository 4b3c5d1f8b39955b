"""Spark side of the query catalogue: one callable ``(spark, base_dir) -> DataFrame`` per key.

Every query reads whole test tables (or frames Spark derives from them);
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortkit.functions import clean
from cohortkit.functions.numeric import pct
from cohortkit.operators import cohort, integrity, keys, measures, profile, rules, series, sketches
from cohortkit.operators.joins import combine_scalars
from cohortkit.plans import fixtures as fx
from cohortkit.session import scratch_path
from cohortkit.sources import files, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def L(spark, base, name):  # noqa: N802 - short alias used throughout
    return files.load(spark, base, name)


# ---------------------------------------------------------------- sources/sinks
@query("scan_project")
def scan_project(spark, base):
    return L(spark, base, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


DOC_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         StructField("lang", StringType()), StructField("source", StringType()),
                         StructField("n_chars", LongType())])


@query("csv_multiline_roundtrip")
def csv_multiline_roundtrip(spark, base):
    path = sinks.write_quoted_csv(L(spark, base, "documents").select(*DOC_SCHEMA.fieldNames()),
                                  scratch_path(spark, "documents-csv"))
    return files.read_quoted_csv(spark, path, DOC_SCHEMA, blank_is_null=False)


@query("tsv_padded_read")
def tsv_padded_read(spark, base):
    c = L(spark, base, "customer")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    padded = c.select(*[F.concat(F.lit("  "), F.col(x).cast("string"), F.lit("   ")).alias(f" {x}  ")
                        for x in cols])
    path = scratch_path(spark, "customer-tsv")
    (padded.write.mode("overwrite").option("header", True).option("sep", "\t")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    t = files.read_padded_tsv(spark, path, cols)
    return t.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                    F.col("c_nationkey").cast("int").alias("c_nationkey"),
                    clean.to_double("c_acctbal").alias("c_acctbal"), "c_mktsegment")


@query("parquet_roundtrip")
def parquet_roundtrip(spark, base):
    path = sinks.write_parquet(L(spark, base, "supplier"), scratch_path(spark, "supplier-parquet"))
    return spark.read.parquet(path)


@query("union_by_name")
def union_by_name(spark, base):
    c = L(spark, base, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                          F.col("c_acctbal").alias("acctbal"), F.lit("customer").alias("source"))
    s = L(spark, base, "supplier").select(F.lit("supplier").alias("source"), F.col("s_acctbal").alias("acctbal"),
                                          F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return files.union_all([c, s])


@query("result_csv")
def result_csv(spark, base):
    """A result table as one sorted CSV file, read back with its types in file order."""
    result = category_share(spark, base)
    path = sinks.write_single_csv(result, scratch_path(spark, "result-csv"), ["level", "cohort"])
    return files.read_result(spark, path, result.schema)


# ---------------------------------------------------------------- profiling
@query("profile_long")
def profile_long(spark, base):
    return profile.profile(L(spark, base, "orders"), "orders",
                           distinct_cols=["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("profile_null_or_blank")
def profile_null_or_blank(spark, base):
    d = fx.dirty_customers(spark, base).select("c_name", "dirty_name", "location", "c_mktsegment")
    return profile.profile(d, "customers_dirty", blank_is_null=True)


@query("profile_schema")
def profile_schema(spark, base):
    return profile.schema_rows(L(spark, base, "orders"), "orders")


@query("null_rates")
def null_rates(spark, base):
    return profile.null_rates(fx.dirty_orders(spark, base), ["lo", "hi", "val", "a", "b", "flag_text"])


@query("top_values")
def top_values(spark, base):
    return profile.top_values(L(spark, base, "part"), ["p_brand", "p_type", "p_size"], k=10)


@query("numeric_summary")
def numeric_summary(spark, base):
    return profile.numeric_summary(L(spark, base, "lineitem"),
                                   ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("profile_table")
def profile_table(spark, base):
    return profile.table_profile(L(spark, base, "orders").select(*ORDER_COLUMNS), "orders",
                                 categoricals=["o_orderstatus", "o_orderpriority"], numerics=["o_totalprice"], k=3)


@query("profile_csv")
def profile_csv(spark, base):
    path = sinks.write_single_csv(profile_table(spark, base), scratch_path(spark, "profile-csv"),
                                  ["dataset", "column", "metric"])
    return files.read_result(spark, path, files.all_strings(["dataset", "column", "metric", "value"]))


@query("ordered_sample")
def ordered_sample(spark, base):
    return L(spark, base, "orders").orderBy("o_orderdate", "o_orderkey").limit(5)


SAMPLE_ROWS = 500
MIDDLE_DATE = "1995-01-01"  # parts the tables where a query merges summaries of two halves


@query("row_sample")
def row_sample(spark, base):
    return profile.sample_rows(L(spark, base, "orders"), SAMPLE_ROWS, "o_orderkey", seed=11)


@query("row_sample_by_level")
def row_sample_by_level(spark, base):
    """Samples of two halves, merged: the sample of the whole."""
    o = L(spark, base, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    early = F.coalesce(F.col("o_orderdate") < F.lit(MIDDLE_DATE), F.lit(False))
    halves = [profile.sample_rows(o.filter(part), 40, "o_orderkey", seed=11, by=["o_orderpriority"]).drop("o_orderdate") for part in (early, ~early)]
    return profile.sample_rows(halves[0].unionByName(halves[1]), 40, "o_orderkey", seed=11, by=["o_orderpriority"])


@query("distinct_sketch_merge")
def distinct_sketch_merge(spark, base):
    """Sketches stored per month, merged in two ways, against exact counts; the error is stated for four deviations."""
    cols = ["o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey"]
    o = L(spark, base, "orders").select(*cols).withColumn("month", F.trunc("o_orderdate", "month"))
    path = sinks.write_parquet(sketches.distinct_sketches(o, cols, ["month"]), scratch_path(spark, "distinct-sketches"))
    stored = spark.read.parquet(path)
    halves = sketches.merge_distinct(stored.withColumn("half", F.month("month") <= 6), ["half"])
    all_at_once = sketches.estimate_distinct(sketches.merge_distinct(stored))
    by_halves = sketches.estimate_distinct(sketches.merge_distinct(halves)).withColumnRenamed("estimate", "by_halves")
    joined = sketches.distinct_exact(o, cols).join(all_at_once, "column").join(by_halves, "column")
    off = F.abs(F.col("estimate") - F.col("exact"))
    return joined.select("column", "exact", (F.col("estimate") == F.col("by_halves")).alias("merges_agree"),
                         (off <= 4 * sketches.HLL_ERROR * F.col("exact")).alias("within_error"))


@query("frequent_values")
def frequent_values(spark, base):
    """The most frequent parts, customers and users; count tables of two halves are merged for the first."""
    li = L(spark, base, "lineitem").select("l_partkey", "l_shipdate")
    early = F.coalesce(F.col("l_shipdate") < F.lit(MIDDLE_DATE), F.lit(False))
    halves = [sketches.hashed_counts(li.filter(part), "l_partkey") for part in (early, ~early)]
    parts = sketches.frequent_values(li, "l_partkey", counts=halves[0].unionByName(halves[1]))
    return (parts.unionByName(sketches.frequent_values(L(spark, base, "orders"), "o_custkey"))
            .unionByName(sketches.frequent_values(L(spark, base, "events"), "user_id")))


# ---------------------------------------------------------------- scalar cleaning
@query("split_location")
def split_location(spark, base):
    d = fx.dirty_customers(spark, base)
    return d.select("c_custkey", "location", clean.split_part("location", 0).alias("city"),
                    clean.split_part("location", 1).alias("state"))


@query("epoch_millis_date")
def epoch_millis_date(spark, base):
    e = L(spark, base, "events")
    millis = F.concat(clean.ntz_epoch_millis("ts").cast("string"), F.lit(".0"))
    text = F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(millis)
    return (e.select("event_id", text.alias("millis_text"))
            .withColumn("event_date", clean.epoch_millis_to_date("millis_text")))


@query("parse_date_lenient")
def parse_date_lenient(spark, base):
    o = L(spark, base, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 10
    m, dd, y = (F.month(d).cast("string"), F.dayofmonth(d).cast("string"), F.year(d).cast("string"))
    text = (F.when(k == 0, F.lit("")).when(k == 1, F.lit("n/a"))
            .when(k == 2, F.concat(m, F.lit("/31/"), y))
            .when(k == 3, F.concat(F.lit("13/"), dd, F.lit("/"), y))
            .otherwise(F.concat(m, F.lit("/"), dd, F.lit("/"), y)))
    return (o.select("o_orderkey", text.alias("date_text"))
            .withColumn("parsed_date", clean.parse_date("date_text")))


@query("typed_casts")
def typed_casts(spark, base):
    li = L(spark, base, "lineitem")
    k = F.col("l_linenumber") % 5
    q = F.col("l_quantity").cast("bigint").cast("string")
    disc = F.concat(F.lit("0."), F.lpad(F.round(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0"))
    text = (F.when(k == 0, q).when(k == 1, F.concat(q, F.lit(".0"))).when(k == 2, F.lit("x"))
            .when(k == 3, F.lit("")).otherwise(disc))
    return (li.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("code"),
                      text.alias("qty_text"))
            .withColumn("as_int", clean.to_int("qty_text"))
            .withColumn("as_double", clean.to_double("qty_text")))


@query("flag_coerce")
def flag_coerce(spark, base):
    return (fx.dirty_orders(spark, base).select("o_orderkey", "flag_text")
            .withColumn("flag", clean.to_flag("flag_text")))


@query("normalize_key")
def normalize_key(spark, base):
    d = fx.dirty_customers(spark, base)
    return d.select("c_custkey", "dirty_name", clean.canonical_key("dirty_name").alias("key"))


# literal alias map of the test data (the reference's is REFERENCE_ALIASES)
TEST_ALIASES = {"customer#000000002,": "customer#000000002", "customer#000000005 ltd.": "customer#000000005"}


@query("alias_map")
def alias_map(spark, base):
    k = normalize_key(spark, base).select("c_custkey", "key")
    return keys.apply_aliases(k, "key", TEST_ALIASES, out="canonical")


def alias_table(spark, base):
    """Dictionary derived from the data: normalized dirty name -> canonical name, where they differ."""
    d = fx.dirty_customers(spark, base)
    k = clean.canonical_key("dirty_name")
    return (d.filter(F.col("dirty_name").isNotNull() & (k != F.lower("c_name")) & (k != ""))
            .select(k.alias("alias"), F.lower("c_name").alias("canonical")))


@query("alias_dictionary")
def alias_dictionary(spark, base):
    d = fx.dirty_customers(spark, base).select("c_custkey", clean.canonical_key("dirty_name").alias("key"))
    o = L(spark, base, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    facts = o.join(d, "c_custkey", "inner").select("o_orderkey", "key")
    return keys.apply_alias_table(facts, "key", alias_table(spark, base), out="resolved")


# ---------------------------------------------------------------- series decode / filters
@query("series_code_decode")
def series_code_decode(spark, base):
    return series.decode(fx.raw_series(spark, base), keep_id=True)


@query("series_filter")
def series_filter(spark, base):
    return rules.apply_rules(fx.raw_series(spark, base), series.series_rules())


# ---------------------------------------------------------------- row rules and audit
@query("drop_inverted_range")
def drop_inverted_range(spark, base):
    r = [rules.Rule("inverted_range", rules.inverted_range("lo", "hi"))]
    return rules.apply_rules(fx.dirty_orders(spark, base), r).select("o_orderkey", "lo", "hi")


@query("drop_out_of_bounds")
def drop_out_of_bounds(spark, base):
    r = [rules.Rule("out_of_bounds", rules.out_of_bounds("val", *fx.BOUNDS))]
    return rules.apply_rules(fx.dirty_orders(spark, base), r).select("o_orderkey", "val")


@query("drop_all_null")
def drop_all_null(spark, base):
    r = [rules.Rule("all_measures_null", rules.all_null(["a", "b"]))]
    return rules.apply_rules(fx.dirty_orders(spark, base), r).select("o_orderkey", "a", "b")


@query("clean_audit")
def clean_audit(spark, base):
    a = rules.audit(fx.dirty_orders(spark, base), fx.order_rules(), "orders_dirty")
    b = rules.audit(fx.raw_series(spark, base), series.series_rules(), "series_raw")
    return a.unionByName(b)


@query("clean_write_audit")
def clean_write_audit(spark, base):
    """The clean tables are written and audited in one pass each; the rows read back join the audit."""
    orders, raw = scratch_path(spark, "orders-clean"), scratch_path(spark, "series-clean")
    a = rules.write_clean(fx.dirty_orders(spark, base), fx.order_rules(), "orders_dirty", orders,
                          checks={"all_null_measures": rules.all_null(["a", "b"])})
    b = rules.write_clean(fx.raw_series(spark, base), series.series_rules(), "series_raw", raw, then=series.decode)
    back = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("value")).select(F.lit(d).alias("dataset"), F.lit("written_row_count").alias("metric"), "value")
            for d, p in (("orders_dirty", orders), ("series_raw", raw))]
    return a.unionByName(b).unionByName(back[0]).unionByName(back[1])


# ---------------------------------------------------------------- lookups, bridge
def _items(spark, base):
    return L(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")


def _part_lookup(spark, base):
    return L(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")


def _short_lookup(spark, base):
    """Code table that misses the parts above size 40, so that some codes are orphans."""
    return (L(spark, base, "part").filter(F.col("p_size") <= 40)
            .select(F.col("p_partkey").alias("l_partkey"), "p_type"))


@query("lookup_left_join")
def lookup_left_join(spark, base):
    return _items(spark, base).join(_part_lookup(spark, base), "l_partkey", "left")


@query("lookup_drop_orphans")
def lookup_drop_orphans(spark, base):
    joined = _items(spark, base).join(_short_lookup(spark, base), "l_partkey", "left")
    return (joined.filter(F.col("p_type").isNotNull())
            .select("l_orderkey", "l_linenumber", "l_partkey", "p_type"))


@query("dedup_pairs")
def dedup_pairs(spark, base):
    # deterministic survivor: the smallest part key of each (order, type) pair
    return (lookup_drop_orphans(spark, base).groupBy("l_orderkey", "p_type")
            .agg(F.min("l_partkey").alias("l_partkey")))


# ---------------------------------------------------------------- cohort core
@query("cohort_members")
def cohort_members(spark, base):
    return fx.member_keys(spark, base)


@query("cohort_tag")
def cohort_tag(spark, base):
    o = L(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return cohort.tag(o, fx.member_keys(spark, base), "o_custkey", "user_id")


@query("cohort_tag_prefiltered")
def cohort_tag_prefiltered(spark, base):
    orders = L(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return cohort.tag_prefiltered(orders, fx.member_keys(spark, base), "o_custkey", "user_id")


@query("semi_join_count")
def semi_join_count(spark, base):
    return cohort.semi_join_count(L(spark, base, "orders"), fx.member_keys(spark, base), "o_custkey", "user_id")


@query("join_hit_rate")
def join_hit_rate(spark, base):
    return cohort.join_diagnostic(L(spark, base, "orders"), fx.cohort_events(spark, base), "o_custkey", "user_id")


@query("unmatched_top")
def unmatched_top(spark, base):
    # every cohort event of the test tables has orders, so the misses are customers without such an event
    c = L(spark, base, "customer").select("c_custkey", "c_name", "c_acctbal")
    return cohort.unmatched(c, fx.cohort_events(spark, base), "c_custkey", "user_id",
                            [F.desc_nulls_last("c_acctbal"), F.asc("c_custkey")], k=20)


# ---------------------------------------------------------------- cohort measures
def _tagged(spark, base):
    return fx.tagged_orders(spark, base, ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus"])


@query("median_by_level")
def median_by_level(spark, base):
    """Approximate median: exact while a group has fewer rows than the accuracy, beyond that within rank error."""
    t = _tagged(spark, base).filter(F.col("o_orderpriority").isNotNull())
    return measures.group_median(t.withColumnRenamed("o_orderpriority", "level"), ["cohort", "level"],
                                 "o_totalprice", accuracy=1_000_000)


@query("median_exact")
def median_exact(spark, base):
    t = (_tagged(spark, base).filter(F.col("o_orderpriority").isNotNull())
         .select("cohort", F.col("o_orderpriority").alias("level"),
                 F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")))
    m = measures.group_median(t, ["cohort", "level"], "cents", exact=True, out="median_cents")
    return m.select("cohort", "level", (F.col("median_cents") / 100).alias("median"), "n")


@query("median_sketch_merge")
def median_sketch_merge(spark, base):
    """Quantile sketches stored per level and month, merged by level; the estimate's true rank is counted on the rows."""
    o = L(spark, base, "orders").filter(F.col("o_orderpriority").isNotNull()).select(
        F.col("o_orderpriority").alias("level"), F.trunc("o_orderdate", "month").alias("month"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    path = sinks.write_parquet(sketches.quantile_sketches(o, ["level", "month"], "cents"), scratch_path(spark, "quantile-sketches"))
    merged = sketches.estimate_quantile(sketches.merge_quantiles(spark.read.parquet(path), ["level"]))
    ranks = o.filter("cents IS NOT NULL").join(merged, "level").groupBy("level", "n").agg(
        F.count_if(F.col("cents") < F.col("estimate")).alias("below"), F.count_if(F.col("cents") <= F.col("estimate")).alias("up_to"))
    near = (F.col("below") <= (0.5 + 2 * sketches.KLL_ERROR) * F.col("n") + 1) & (F.col("up_to") >= (0.5 - 2 * sketches.KLL_ERROR) * F.col("n") - 1)
    return ranks.select("level", "n", near.alias("within_error"))


@query("category_share")
def category_share(spark, base):
    t = fx.tagged_counts(spark, base, level=F.col("o_orderpriority"))
    return measures.category_share(t, "cohort", "level", keep=F.col("level").isNotNull(), weight="n")


def _brand_counts_by_part(spark, base):
    """(cohort, l_partkey, cnt): line items per cohort and part, aggregated before the part join."""
    t = fx.tagged_orders(spark, base, ["o_orderkey"]).select("o_orderkey", "cohort")
    li = L(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    return (li.join(t, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
            .groupBy("cohort", "l_partkey").agg(F.count(F.lit(1)).alias("cnt")))


def _with_part(spark, base, col):
    parts = L(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), col)
    return _brand_counts_by_part(spark, base).join(parts, "l_partkey", "inner")


@query("topk_tags_bucketed")
def topk_tags_bucketed(spark, base):
    """``topk_tags`` from tables bucketed by order, whose merge join needs no exchange."""
    return measures.top_k(bucketed_brand_counts(spark, base), "cohort", "p_brand", weight="n")


def bucketed_bridge(spark, base):
    """Tagged orders joined to line items; both are written once, bucketed and sorted by order."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    token = uuid.uuid4().hex
    tagged = fx.tagged_orders(spark, base, ["o_orderkey"]).select("o_orderkey", "cohort")
    o = sinks.write_bucketed(tagged, f"orders_{token}", ["o_orderkey"], buckets, scratch_path(spark, "bucketed-orders"))
    items = L(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    li = sinks.write_bucketed(items, f"items_{token}", ["l_orderkey"], buckets, scratch_path(spark, "bucketed-items"))
    return li.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))


def bucketed_brand_counts(spark, base):
    by_part = bucketed_bridge(spark, base).groupBy("cohort", "l_partkey").agg(F.count(F.lit(1)).alias("cnt"))
    parts = L(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return by_part.join(parts, "l_partkey").groupBy("cohort", "p_brand").agg(F.sum("cnt").cast("bigint").alias("n"))


@query("topk_tags")
def topk_tags(spark, base):
    return measures.top_k(_with_part(spark, base, "p_brand"), "cohort", "p_brand", k=10, weight="cnt")


def _nation_counts(spark, base):
    """(cohort, region, cnt) with orders pre-aggregated per customer before the customer join."""
    per_cust = fx.tagged_counts(spark, base).select("cohort", "o_custkey", F.col("n").alias("cnt"))
    cust = L(spark, base, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = L(spark, base, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = per_cust.join(cust, "o_custkey", "inner").join(nation, "c_nationkey", "inner")
    return j.select("cohort", F.upper("n_name").alias("region"), "cnt", "n_name")


@query("topk_region")
def topk_region(spark, base):
    keep = F.col("n_name").isNotNull() & (F.col("n_name") != "")
    return measures.top_k(_nation_counts(spark, base), "cohort", "region", k=10, keep=keep, weight="cnt")


@query("tag_set_share")
def tag_set_share(spark, base):
    j = _with_part(spark, base, "p_type")
    inside = F.coalesce(F.col("p_type").isin(fx.TYPE_SET), F.lit(False))
    return (j.groupBy("cohort").agg(F.sum("cnt").cast("bigint").alias("total"),
                                    F.sum(F.when(inside, F.col("cnt")).otherwise(0)).cast("bigint").alias("set_n"))
            .withColumn("other_n", F.col("total") - F.col("set_n"))
            .withColumn("set_pct", pct("set_n", "total")))


@query("flag_rate")
def flag_rate(spark, base):
    t = fx.tagged_counts(spark, base, fulfilled=F.col("o_orderstatus") == "F")
    return measures.flag_rate(t, "cohort", F.col("fulfilled"), "fulfilled", weight="n")


def _level_counts(spark, base):
    t = fx.tagged_counts(spark, base, level=F.col("o_orderpriority")).filter(F.col("level").isNotNull())
    return (t.groupBy("cohort", "level").agg(F.sum("n").cast("bigint").alias("n"))
            .withColumn("level_rank", measures.ordinal_rank("level", fx.PRIORITY_ORDER)))


@query("ordinal_levels")
def ordinal_levels(spark, base):
    return _level_counts(spark, base).select("cohort", "level", "level_rank", "n").orderBy("cohort", "level_rank")


@query("ladder_cumulative")
def ladder_cumulative(spark, base):
    c = measures.cumulative_share(_level_counts(spark, base), "cohort", "level_rank", ascending=False,
                                  out="at_or_above_pct")
    return c.select("cohort", "level", "level_rank", "n", "cum_n", "at_or_above_pct")


@query("cumulative_topk")
def cumulative_topk(spark, base, k: int = 10):
    counts = (_with_part(spark, base, "p_brand").groupBy("cohort", "p_brand")
              .agg(F.sum("cnt").cast("bigint").alias("n")))
    top = measures.top_k(counts, "cohort", "p_brand", k=k, weight="n")
    totals = counts.groupBy("cohort").agg(F.sum("n").cast("bigint").alias("total"))
    c = measures.cumulative_share(top.drop("pct_of_cohort"), "cohort", "rank", ascending=True, totals=totals)
    return c.select("cohort", "p_brand", "rank", "n", "cum_n", "cum_pct")


# ---------------------------------------------------------------- series figures
@query("series_select")
def series_select(spark, base):
    return series.select_metric(fx.clean_series(spark, base), "layoffs_discharges_rate")


@query("series_pivot")
def series_pivot(spark, base):
    return series.pivot_metrics(fx.clean_series(spark, base), ["job_openings_rate", "hires_rate"])


WINDOW = ("1999-01-01", "2000-12-31")
PEAK_YEAR = 1997
PLANTED_GAP = ["1993-04", "1995-11", "1995-12", "1997-06"]


@query("window_stats")
def window_stats(spark, base):
    return series.window_stats(fx.clean_series(spark, base), *WINDOW, PEAK_YEAR)


@query("peak_drop")
def peak_drop(spark, base):
    return series.peak_drop(fx.clean_series(spark, base), PEAK_YEAR, *WINDOW)


@query("annual_average")
def annual_average(spark, base):
    return series.annual_average(fx.clean_series(spark, base))


@query("series_crosscheck")
def series_crosscheck(spark, base):
    return series.crosscheck(fx.clean_series(spark, base), "job_openings_rate", "hires_rate")


@query("series_completeness")
def series_completeness(spark, base):
    return series.completeness(fx.clean_series(spark, base))


@query("series_missing_months")
def series_missing_months(spark, base):
    """The decoded series without four months (a planted gap), and the months that each calendar then lacks."""
    gap = F.date_format("obs_date", "yyyy-MM").isin(PLANTED_GAP)
    return series.missing_months(fx.clean_series(spark, base).filter(~gap))


@query("series_composite")
def series_composite(spark, base):
    labels = clean.lookup_label(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in fx.STATUS_INDUSTRY.items() for x in kv]),
                         F.col("o_orderstatus")), series.INDUSTRY_BY_CODE)
    weights = (L(spark, base, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("weight"))
               .select(labels.alias("industry"), "weight").filter(F.col("industry").isNotNull()))
    # weights are an aggregate (one row per status): the join is left to AQE's measured sizes
    return series.composite(fx.clean_series(spark, base), weights)


# ---------------------------------------------------------------- cohort contrasts
COHORTS = [cohort.IN_LABEL, cohort.OUT_LABEL]


@query("level_matrix")
def level_matrix(spark, base):
    m = median_by_level(spark, base)
    wide = measures.pivot_cohorts(m, ["level"], "cohort", {"median": F.first("median"), "n": F.first("n")}, COHORTS)
    prem = F.round(F.try_divide(F.lit(100.0) * (F.col("median_flagged") - F.col("median_rest")),
                                F.col("median_rest")), 2)
    return wide.select("level", "median_flagged", "median_rest", "n_flagged", "n_rest", prem.alias("premium_pct"))


def _slug(level: str) -> str:
    return "pct_" + "".join(ch if ch.isalnum() else "_" for ch in level.lower())


@query("share_matrix")
def share_matrix(spark, base):
    s = category_share(spark, base)
    levels = list(reversed(fx.PRIORITY_ORDER))
    wide = s.groupBy("cohort").pivot("level", levels).agg(F.first("pct_of_cohort"))
    wide = wide.select("cohort", *[F.coalesce(F.col(f"`{lv}`"), F.lit(0.0)).alias(_slug(lv)) for lv in levels])
    return wide


@query("cohort_contrast")
def cohort_contrast(spark, base):
    s = category_share(spark, base)
    wide = measures.pivot_cohorts(s, ["level"], "cohort", {"pct": F.first("pct_of_cohort")}, COHORTS)
    gap, ratio = measures.contrast(F.col("pct_flagged"), F.col("pct_rest"))
    top = s.agg(F.max("pct_of_cohort")).scalar()  # shared scale: a scalar subquery, no join
    return wide.select("level", "pct_flagged", "pct_rest", gap.alias("gap_pp"), ratio.alias("ratio"),
                       top.alias("max_pct"))


@query("topk_rank_compare")
def topk_rank_compare(spark, base, k: int = 10):
    counts = (_with_part(spark, base, "p_brand").groupBy("cohort", "p_brand")
              .agg(F.sum("cnt").cast("bigint").alias("n")))
    w = Window.partitionBy("cohort").orderBy(F.desc("n"), F.asc("p_brand"))
    top = counts.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)  # WindowGroupLimit
    cands = top.select("p_brand").distinct()                      # at most 2k brands
    own = counts.join(F.broadcast(cands), "p_brand", "inner")     # candidate counts per cohort
    # exact rank = 1 + brands of the same cohort ahead of it (more items, or tie and smaller name)
    # `own` holds at most k brands per cohort: a proven bound, so it is broadcast and the
    # (possibly large) counts table streams past it instead of shuffling on the cohort key
    ahead = F.broadcast(own.alias("c")).join(counts.alias("o"), F.col("c.cohort") == F.col("o.cohort"), "inner").filter(
        (F.col("o.n") > F.col("c.n")) | ((F.col("o.n") == F.col("c.n")) & (F.col("o.p_brand") < F.col("c.p_brand"))))
    ahead_n = ahead.groupBy(F.col("c.cohort").alias("cohort"), F.col("c.p_brand").alias("p_brand")).agg(
        F.count(F.lit(1)).alias("ahead"))
    ranked = (own.join(ahead_n, ["cohort", "p_brand"], "left")
              .withColumn("rank", (F.coalesce(F.col("ahead"), F.lit(0)) + 1).cast("int")))
    wide = measures.pivot_cohorts(ranked, ["p_brand"], "cohort", {"n": F.first("n"), "rank": F.first("rank")},
                                  COHORTS)
    in_f = F.coalesce(F.col("rank_flagged") <= k, F.lit(False))
    in_r = F.coalesce(F.col("rank_rest") <= k, F.lit(False))
    return wide.select("p_brand", "n_flagged", "rank_flagged", "n_rest", "rank_rest",
                       in_f.alias("top_flagged"), in_r.alias("top_rest"), (in_f != in_r).alias("missing_from_other"))


@query("member_totals")
def member_totals(spark, base, k: int = 20):
    ev = (fx.cohort_events(spark, base).groupBy("user_id")
          .agg(F.count(F.lit(1)).alias("n_events"),
               F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")))
    orders = (L(spark, base, "orders").groupBy(F.col("o_custkey").alias("user_id"))
              .agg(F.count(F.lit(1)).alias("n_orders")))
    j = ev.join(orders, "user_id", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)).cast("bigint"))
    order = [F.desc("total_value"), F.asc("user_id")]
    top = j.orderBy(*order).limit(k)  # TakeOrderedAndProject: per-partition top-k, then merge
    return (top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # k rows only
            .select("rank", "user_id", "n_events", F.col("total_value").cast("double").alias("total_value"),
                    "n_orders"))


@query("weighted_hit_rate")
def weighted_hit_rate(spark, base):
    ev = (fx.cohort_events(spark, base).groupBy("user_id")
          .agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("w")))
    keys_ = L(spark, base, "orders").select(F.col("o_custkey").alias("user_id")).distinct()
    hit = ev.join(keys_, "user_id", "left_semi")
    r = combine_scalars(ev.agg(F.sum("w").cast("bigint").alias("total_weight")),
                        hit.agg(F.coalesce(F.sum("w"), F.lit(0)).cast("bigint").alias("matched_weight")))
    return r.select("matched_weight", "total_weight", pct("matched_weight", "total_weight").alias("weighted_pct"))


# ---------------------------------------------------------------- integrity
def _clean_orders(spark, base):
    return rules.apply_rules(fx.dirty_orders(spark, base), fx.order_rules())


@query("orphan_tags")
def orphan_tags(spark, base):
    li = L(spark, base, "lineitem").select("l_orderkey")
    return integrity.orphans(li, _clean_orders(spark, base), "l_orderkey", "o_orderkey")


@query("integrity_checks")
def integrity_checks(spark, base):
    orders = L(spark, base, "orders")
    tagged = fx.tagged_orders(spark, base, ["o_custkey"])
    return (integrity.duplicate_keys(dedup_pairs(spark, base), ["l_orderkey", "p_type"])
            .unionByName(integrity.all_null_rows(_clean_orders(spark, base), ["a", "b"]))
            .unionByName(integrity.reconcile(orders, tagged, "o_custkey")))


# ---------------------------------------------------------------- proposed (tier P)
RECENCY_CUTOFF = "2024-01-15"


@query("recency_cohort")
def recency_cohort(spark, base):
    ev = L(spark, base, "events").filter(F.col("event_type") == fx.COHORT_EVENT)
    o = cohort.key_counts(L(spark, base, "orders"), "o_custkey")  # one row per customer
    t = cohort.recency_tag(o, ev, "o_custkey", "user_id", "ts", RECENCY_CUTOFF)
    return t.groupBy("cohort").agg(F.sum("n").cast("bigint").alias("n_orders"), F.count(F.lit(1)).alias("n_customers"))


@query("matched_strata")
def matched_strata(spark, base):
    per_cust = fx.tagged_counts(spark, base, f=F.col("o_orderstatus") == "F")
    cust = L(spark, base, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    counts = (per_cust.join(cust, "o_custkey", "inner").groupBy("c_mktsegment", "cohort")
              .agg(F.sum("n").cast("bigint").alias("n"),
                   F.sum(F.when(F.col("f"), F.col("n")).otherwise(0)).cast("bigint").alias("fulfilled_n")))
    kept = cohort.both_sided_strata(counts, "c_mktsegment")
    return kept.withColumn("fulfilled_pct", pct("fulfilled_n", "n"))


@query("null_aware_rate")
def null_aware_rate(spark, base):
    counts = cohort.key_counts(fx.dirty_orders(spark, base), "o_custkey", {"known_flag": clean.to_nullable_flag("flag_text")})
    d = cohort.tag(counts, fx.member_keys(spark, base), "o_custkey", "user_id")
    return measures.null_aware_rate(d, "cohort", F.col("known_flag"), "flag", weight="n")


SMALL_CELL_MIN = 50


@query("small_cells")
def small_cells(spark, base):
    c = _nation_counts(spark, base).groupBy("cohort", "region").agg(F.sum("cnt").cast("bigint").alias("n"))
    c = measures.with_totals(c, "cohort", out="__total").withColumn("pct_of_cohort", pct("n", "__total"))
    return measures.small_cells(c.drop("__total"), SMALL_CELL_MIN, ["pct_of_cohort"])


# alternative code sets for the sensitivity of the set share (a parameter table)
TYPE_SETS = {"core": ["ECONOMY", "SMALL"], "narrow": ["ECONOMY"], "wide": ["ECONOMY", "SMALL", "STANDARD"]}


@query("set_sensitivity")
def set_sensitivity(spark, base):
    rows = [(name, code) for name, codes in TYPE_SETS.items() for code in codes]
    sets = spark.createDataFrame(rows, "set_name string, p_type string")
    per_type = _with_part(spark, base, "p_type").groupBy("cohort", "p_type").agg(F.sum("cnt").alias("n"))
    totals = per_type.groupBy("cohort").agg(F.sum("n").cast("bigint").alias("total"))
    inside = (per_type.join(F.broadcast(sets), "p_type", "inner").groupBy("set_name", "cohort")
              .agg(F.sum("n").cast("bigint").alias("set_n")))
    return (inside.join(totals, "cohort", "inner")
            .select("set_name", "cohort", "total", "set_n", pct("set_n", "total").alias("set_pct")))


DRAWS = 1000  # equal-size draws of the noise baselines
BOOTSTRAP_REPS = 200


@query("bootstrap_rate")
def bootstrap_rate(spark, base):
    from cohortkit.operators import resample

    return resample.drawn_rate(_tagged(spark, base), "cohort", cohort.IN_LABEL, cohort.OUT_LABEL, "o_orderkey",
                               F.col("o_orderstatus") == "F", reps=DRAWS)


@query("bootstrap_median_baseline")
def bootstrap_median_baseline(spark, base):
    from cohortkit.operators import resample

    t = _tagged(spark, base).select("o_orderkey", "cohort", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return resample.drawn_median(t, "cohort", cohort.IN_LABEL, cohort.OUT_LABEL, "o_orderkey", "cents", reps=DRAWS)


@query("bootstrap_median")
def bootstrap_median(spark, base):
    from cohortkit.operators import resample

    t = _tagged(spark, base).filter((F.col("cohort") == cohort.IN_LABEL) & (F.col("o_orderpriority") == "1-URGENT"))
    cell = t.select(F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    r = resample.bootstrap_median(cell, "cents", reps=BOOTSTRAP_REPS)
    # reported in cents precision (dollars, 2 places)
    return r.select(F.lit(cohort.IN_LABEL).alias("cohort"), F.lit("1-URGENT").alias("level"), "n", "reps",
                    F.round(F.col("median") / 100, 2).alias("median"), F.round(F.col("ci_low") / 100, 2).alias("ci_low"),
                    F.round(F.col("ci_high") / 100, 2).alias("ci_high"))


FUZZY_MAX_DIST = 1


@query("fuzzy_key_match")
def fuzzy_key_match(spark, base):
    from cohortkit.operators import fuzzy

    d = fx.dirty_customers(spark, base)
    keys_ = d.select(clean.canonical_key("dirty_name").alias("key")).filter(
        F.col("key").isNotNull() & (F.col("key") != ""))
    canon = d.select(F.lower("c_name").alias("canonical")).filter(F.col("canonical").isNotNull())
    unmatched_keys = keys_.join(canon, F.col("key") == F.col("canonical"), "left_anti")
    return fuzzy.fuzzy_pairs(unmatched_keys, "key", canon, "canonical", FUZZY_MAX_DIST)
