"""Key canonicalisation: literal alias maps and alias dictionaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.joins import per_key

# --- fixed values (the reference's fact-side alias list) -------------------
REFERENCE_ALIASES = {"x": "twitter", "x corp": "twitter"}
# ---------------------------------------------------------------------------


def apply_aliases(df: DataFrame, key: str, aliases: Mapping[str, str], out: str | None = None) -> DataFrame:
    """Replace keys found in a small literal map; other keys (and NULL) pass through."""
    out = out or key
    if not aliases:
        return df.withColumn(out, F.col(key))
    pairs = []
    for k, v in aliases.items():
        pairs += [F.lit(k), F.lit(v)]
    mapped = F.try_element_at(F.create_map(*pairs), F.col(key))
    return df.withColumn(out, F.when(F.col(key).isNull(), F.lit(None).cast("string"))
                         .otherwise(F.coalesce(mapped, F.col(key))))


def apply_alias_table(df: DataFrame, key: str, table: DataFrame, alias_col: str = "alias",
                      canonical_col: str = "canonical", out: str | None = None) -> DataFrame:
    """Resolve ``key`` through an alias dictionary held as a table.

    The dictionary is reduced to one canonical per alias (the smallest, so
    a conflicting dictionary still resolves deterministically) and joined on
    the alias.  Spark decides the join; a hot key is split by AQE
    (``joins.per_key``).
    """
    out = out or key
    named = table.filter(F.col(alias_col).isNotNull()).select(F.col(alias_col).alias("__alias"), canonical_col)
    resolved = per_key(named, "__alias", F.min(canonical_col).alias("__canonical"))
    joined = df.join(resolved, F.col(key) == F.col("__alias"), "left")
    return (joined.withColumn(out, F.coalesce(F.col("__canonical"), F.col(key)))
            .drop("__alias", "__canonical"))
