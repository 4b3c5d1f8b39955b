"""A bounded sample of labelled texts, fixed by a hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; the fold rule of labelled rows."""
    return F.pmod(F.crc32(F.encode(id_col.cast("string"), "UTF-8")), F.lit(folds))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows_per_class: int) -> DataFrame:
    """``doc_id, text, y`` of at most ``rows_per_class`` documents of each label outside the held-out fold.

    The documents with the smallest hashes of their ids are taken.  Ids and
    labels that are null take no part; of contradicting labels the larger holds.
    The sample's ids are at most 2 x ``rows_per_class`` rows and are broadcast.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    known = known.filter(remainder(F.col("doc_id"), folds) != held_out)
    order = F.xxhash64("doc_id")
    chosen = known.filter("y = 1").orderBy(order, "doc_id").limit(rows_per_class).unionByName(
        known.filter("y = 0").orderBy(order, "doc_id").limit(rows_per_class))
    return docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
