"""Column-level building blocks (pure expressions, no actions)."""

from cohortkit.functions.clean import (
    canonical_key,
    epoch_millis_to_date,
    first_of_month,
    lookup_label,
    parse_date,
    split_part,
    to_double,
    to_flag,
    to_int,
    to_nullable_flag,
)
from cohortkit.functions.numeric import pct, round_half_up_ratio

__all__ = [
    "canonical_key", "epoch_millis_to_date", "first_of_month", "lookup_label",
    "parse_date", "split_part", "to_double", "to_flag", "to_int", "to_nullable_flag",
    "pct", "round_half_up_ratio",
]
