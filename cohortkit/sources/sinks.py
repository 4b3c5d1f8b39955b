"""Sinks.  Results are written idempotently (mode overwrite)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """Columnar copy; ``partition_by`` (e.g. a date) enables partition pruning later."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_quoted_csv(df: DataFrame, path: str) -> str:
    """Distributed CSV (one file per partition) that ``read_quoted_csv`` reads back exactly.

    Writer whitespace trimming is switched off (Spark trims by default on
    write), quotes are doubled, and an empty string stays distinguishable
    from NULL.
    """
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def write_single_csv(df: DataFrame, path: str, order_by: Sequence[str] | None = None) -> str:
    """One CSV file with a header, for already-aggregated results only.

    A global sort before ``coalesce(1)`` keeps the row order in the file.
    """
    if order_by:
        df = df.orderBy(*order_by)
    write_quoted_csv(df.coalesce(1), path)
    return path


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``keys`` at ``path``; return the table.

    Tables bucketed on the same keys with the same bucket count join without
    a shuffle (each bucket pair is joined by one task), so a fact table and
    its bridge that are joined again and again are written this way once.
    The table is external (its files live at ``path``, e.g. under the shared
    checkpoint folder) and registered in the session catalog.
    """
    (df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
