import importlib

from pyspark.sql import functions as F

from cohortkit.plans import catalog
from tests.conftest import plan_text


def test_entry_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"cohort", "level", "median", "n"}
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(catalog.QUERIES) <= set(q)
    assert set(catalog.QUERIES) - set(o) == set(entry.NO_ORACLE)


def test_scan_prunes_columns_and_pushes_filters(spark, base):
    df = catalog.L(spark, base, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    s = plan_text(df)
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in s
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in s


def test_topk_uses_window_group_limit(spark, base):
    s = plan_text(catalog.topk_tags(spark, base))
    assert "WindowGroupLimit" in s


def test_no_cartesian_products_in_catalogue(spark, base):
    heavy = ["join_hit_rate", "integrity_checks", "orphan_tags", "bootstrap_rate", "cohort_contrast",
             "weighted_hit_rate", "fuzzy_key_match", "topk_rank_compare"]
    for name in heavy:
        s = plan_text(catalog.QUERIES[name](spark, base), "simple")
        assert "CartesianProduct" not in s and "BroadcastNestedLoopJoin" not in s, name
