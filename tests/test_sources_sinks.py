import glob
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortkit.session import scratch_path
from cohortkit.sources import files, sinks
from tests.conftest import rows

TRICKY = ['plain', 'with "quotes" inside', 'multi\nline\ntext', '  padded  ', '', None, 'comma, and "q"\n']


def test_quoted_csv_roundtrip_exact(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "id long, text string")
    path = sinks.write_quoted_csv(df.repartition(3), scratch_path(spark, "t-csv"))
    schema = StructType([StructField("id", LongType()), StructField("text", StringType())])
    back = files.read_quoted_csv(spark, path, schema, blank_is_null=False)
    assert sorted(rows(back), key=lambda r: r[0]) == list(enumerate(TRICKY))
    back = files.read_quoted_csv(spark, path, schema)  # by default a quoted blank is NULL
    assert sorted(rows(back), key=lambda r: r[0]) == [(i, t or None) for i, t in enumerate(TRICKY)]


def test_single_csv_keeps_order(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "g int, v int").repartition(5)
    path = sinks.write_single_csv(df, scratch_path(spark, "t-one"), order_by=["g", "v"])
    parts = glob.glob(os.path.join(path.replace("file:", ""), "part-*.csv"))
    assert len(parts) == 1
    lines = open(parts[0]).read().strip().split("\n")[1:]
    got = [tuple(int(x) for x in ln.split(",")) for ln in lines]
    assert got == sorted((i % 7, i) for i in range(50))


def test_padded_tsv(spark):
    d = tempfile.mkdtemp(prefix="tsv-")
    with open(os.path.join(d, "f.tsv"), "w") as fh:
        fh.write("series_id        \tyear\tperiod\t  value\n")
        fh.write("JTS510000000000000LDR   \t2023\tM07\t  1.1\n")
    got = rows(files.read_padded_tsv(spark, d, ["series_id", "year", "period", "value"]))
    assert got == [("JTS510000000000000LDR", "2023", "M07", "1.1")]
    both = files.read_series(spark, [d, d], ["series_id", "year", "period", "value"], ["value", "series_id"])
    assert rows(both) == [("1.1", "JTS510000000000000LDR")] * 2


def test_union_by_name_reorders(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted(rows(files.union_all([a, b]), "k", "v")) == [(1, "x"), (2, "y")]


def test_parquet_roundtrip_partitioned(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    path = sinks.write_parquet(df, scratch_path(spark, "t-pq"), partition_by=["p"])
    back = spark.read.parquet(path)
    assert sorted(rows(back.filter(F.col("p") == "b"), "k", "p")) == [(2, "b")]


def test_read_result_typed_and_missing(spark):
    import datetime as dt

    import pytest
    from pyspark.sql.types import DateType, DoubleType

    df = spark.createDataFrame([(dt.date(2023, 7, 1), 1.1)], "obs_date date, v double")
    path = sinks.write_single_csv(df, scratch_path(spark, "t-res"))
    schema = StructType([StructField("obs_date", DateType()), StructField("v", DoubleType())])
    assert rows(files.read_result(spark, path, schema)) == [(dt.date(2023, 7, 1), 1.1)]
    with pytest.warns(UserWarning):
        assert files.read_result(spark, path + "-missing", schema) is None


def test_bucketed_tables_join_without_shuffle(spark, base):
    from tests.conftest import plan_text

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = files.load(spark, base, "orders").select("o_orderkey", "o_custkey")
        items = files.load(spark, base, "lineitem").select("l_orderkey", "l_partkey")
        o = sinks.write_bucketed(orders, "t_orders_b", ["o_orderkey"], 8, scratch_path(spark, "b-orders"))
        li = sinks.write_bucketed(items, "t_items_b", ["l_orderkey"], 8, scratch_path(spark, "b-items"))
        j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        plan = plan_text(j, "simple")
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert j.count() == items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
