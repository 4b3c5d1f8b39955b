"""Scalar cleaning expressions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Spark 4 runs with ANSI mode on; dirty text therefore goes through
``try_cast`` / ``try_to_date`` and never through a strict cast, even after a
filter (the optimizer may evaluate a projection before the filter).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for identical results) ---------
# Trailing legal-form suffix removed from company names, one occurrence,
# case-insensitive, optional dot, any (also zero) leading whitespace.
LEGAL_SUFFIX_PATTERN = r"(?i)\s*(inc|corp|corporation|llc|ltd|limited)\.?$"
# Text date layout of the event file.
EVENT_DATE_FORMAT = "M/d/yyyy"
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_part(col: Column | str, index: int, sep: str = ",") -> Column:
    """Part ``index`` (0-based) of ``col`` split on ``sep``, trimmed and lower-cased.

    A missing part is NULL (``get`` instead of ``getItem``, which raises under
    ANSI mode); parts after the requested one are ignored.
    """
    pattern = "\\" + sep if sep in ".^$|?*+()[]{}\\" else sep
    return F.lower(F.trim(F.get(F.split(_c(col), pattern), index)))


def epoch_millis_to_date(col: Column | str) -> Column:
    """Epoch milliseconds held as text (``'1713397508000.0'``) to a UTC date.

    Whole days since the epoch, so the result does not depend on the
    session time zone.
    """
    millis = _c(col).try_cast("double")
    return F.date_from_unix_date(F.floor(millis / F.lit(86400000)).cast("int"))


def ntz_epoch_millis(col: Column | str) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` wall-clock value read as UTC (zone-independent)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(col))


def parse_date(col: Column | str, fmt: str = EVENT_DATE_FORMAT) -> Column:
    """Lenient text-date parse: a bad, blank or impossible date is NULL."""
    return F.try_to_date(_c(col), fmt)


def to_double(col: Column | str) -> Column:
    return _c(col).try_cast("double")


def to_int(col: Column | str) -> Column:
    """Lenient integer: ``'120'`` and ``'120.0'`` give 120, junk gives NULL."""
    return _c(col).try_cast("double").try_cast("int")


def to_flag(col: Column | str) -> Column:
    """Two-valued flag: numeric 1 is true, everything else (NULL too) false."""
    return F.coalesce(_c(col).try_cast("double") == F.lit(1.0), F.lit(False))


def to_nullable_flag(col: Column | str) -> Column:
    """Three-valued flag: NULL or blank stays unknown (NULL), 1 is true, else false."""
    c = _c(col)
    return (F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("boolean"))
             .otherwise(F.coalesce(c.try_cast("double") == F.lit(1.0), F.lit(False))))


def canonical_key(col: Column | str, pattern: str = LEGAL_SUFFIX_PATTERN) -> Column:
    """Join key from a free-text name: drop one trailing legal suffix, trim, lower.

    The observable quirks of this rule are part of the contract: ``\\s*``
    allows zero spaces (``Zinc`` -> ``z``), a comma before the suffix stays,
    and a blank after the dot defeats the ``$`` anchor.
    """
    return F.lower(F.trim(F.regexp_replace(_c(col), pattern, "")))


def first_of_month(year: Column | str, month: Column | str) -> Column:
    """First day of ``year``-``month``; NULL when the month is not 1..12."""
    y, m = _c(year), _c(month)
    return F.when(m.between(1, 12) & y.isNotNull(), F.make_date(y, m, F.lit(1)))


def lookup_label(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """Code-to-label lookup with pass-through of unknown codes."""
    if not mapping:
        return _c(col)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _c(col)), _c(col))
