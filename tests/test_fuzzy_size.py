"""The fuzzy key match sends no table of keys or variants to the driver."""

from cohortkit.operators.fuzzy import fuzzy_pairs
from pyspark.sql import functions as F
from tests.conftest import plan_text


def test_variants_are_never_broadcast(spark):
    """The planner takes the variants for as small as their keys, so only a named strategy keeps them from the driver."""
    left = spark.range(0, 40).select(F.concat(F.lit("key#"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(",")).alias("k"))
    right = spark.range(0, 60).select(F.concat(F.lit("key#"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    out = fuzzy_pairs(left, "k", right, "c", 1)
    assert sorted(tuple(r) for r in out.collect()) == [(f"key#{i:06d},", f"key#{i:06d}", 1) for i in range(40)]
    plan = plan_text(out)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
