"""File sources.

* Quoted CSV with embedded newlines and doubled-quote escapes needs
  ``multiLine``; such a file cannot be split, so ingest it once to Parquet
  (many files in, many tasks) and work from the Parquet copy.
* Tab-separated files with padded headers and fields are trimmed on read.
* Parquet gets predicate pushdown and column pruning from Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence
import warnings
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table ``<base>/<name>.parquet``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def all_strings(cols: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType | Sequence[str] | None = None,
                    header: bool = True, blank_is_null: bool = True) -> DataFrame:
    """CSV with a header, quoted fields spanning lines and ``""`` escapes.

    A quoted empty field is NULL, like an unquoted one; with
    ``blank_is_null=False`` it is an empty string.  Pass a schema (or a
    column list, read as strings) to avoid inference.
    """
    reader = spark.read.options(header=header, multiLine=True, quote='"', escape='"')
    if not blank_is_null:
        reader = reader.option("nullValue", "\u0000")  # a value no field has, so that blanks stay apart from NULL
    if schema is not None:
        reader = reader.schema(schema if isinstance(schema, StructType) else all_strings(schema))
    return reader.csv(path)


def read_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A written result directory (CSV with header) read back with explicit types.

    Returns ``None`` with a warning when the directory does not exist, so a
    report can skip a result that was not produced.
    """
    try:
        return read_quoted_csv(spark, path, schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        warnings.warn(f"no result at {path}; skipped", stacklevel=2)
        return None


def read_padded_tsv(spark: SparkSession, path: str, header: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Tab-separated file with padded header names and values, all strings.

    ``header`` names the file's columns in order (the padded header line is
    skipped, never parsed, and no inference job runs); the reader itself
    strips the white space around values.  ``cols`` keeps a selection.
    """
    reader = spark.read.schema(all_strings(header)).options(
        sep="\t", header=True, enforceSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return reader.csv(path).select(*(cols or header))


def read_series(spark: SparkSession, paths: Sequence[str], header: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Several padded tab-separated files of one layout as one table: one scan over all of them."""
    return read_padded_tsv(spark, list(paths), header, cols)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name (column order may differ between inputs)."""
    return reduce(lambda a, b: a.unionByName(b), frames)
