"""Exact percentage and ratio rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pct(n: Column | str, total: Column | str, scale: int = 2) -> Column:
    """``ROUND(100.0 * n / total, scale)`` in decimal arithmetic, as double.

    Decimal keeps the half-up rounding exact (a double would round 1.005
    down).  A zero or NULL total gives NULL instead of raising.
    """
    hundred = F.lit(Decimal("100.0"))
    ratio = F.try_divide(hundred * _c(n).cast("decimal(20,0)"), _c(total).cast("decimal(20,0)"))
    return F.round(ratio, scale).cast("double")


def round_half_up_ratio(num: Column | str, den: Column | str, scale: int = 2,
                        factor: int = 1) -> Column:
    """``factor * num / den`` rounded half-up to ``scale`` places, exactly.

    ``num`` and ``den`` are integral (counts, cents, tenths); the result is
    the nearest ``10**-scale`` step computed in decimal, returned as double.
    """
    f = Decimal(factor)
    ratio = F.try_divide(F.lit(f) * _c(num).cast("decimal(20,0)"), _c(den).cast("decimal(20,0)"))
    return F.round(ratio, scale).cast("double")
