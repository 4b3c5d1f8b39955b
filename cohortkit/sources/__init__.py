"""Readers and writers: quoted multi-line CSV, padded TSV, Parquet."""

from cohortkit.sources.files import (
    TABLES,
    load,
    read_padded_tsv,
    read_quoted_csv,
    read_result,
    union_all,
)
from cohortkit.sources.sinks import write_bucketed, write_parquet, write_quoted_csv, write_single_csv

__all__ = ["TABLES", "load", "read_padded_tsv", "read_quoted_csv", "read_result", "union_all",
           "write_bucketed", "write_parquet", "write_quoted_csv", "write_single_csv"]
