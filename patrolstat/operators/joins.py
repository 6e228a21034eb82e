"""Equi joins: profile enrichment, key lists (semi join), re-keying.

The strategy is left to Spark: the planner broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans from the *measured* shuffle sizes (broadcast when a side turns out
small, split skewed partitions otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_join(profile: DataFrame, facts: DataFrame, key: str | list[str]) -> DataFrame:
    """Inner join each fact row to its profile row (1:N); unmatched facts vanish."""
    return facts.join(profile, on=key, how="inner")


def semi_join_filter(df: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` appears in ``keys`` (membership in a key list)."""
    return df.join(keys.select(F.col(keys_key or key).alias(key)), on=key, how="left_semi")


def rekey_join(df: DataFrame, mapping: DataFrame, old_key: str, new_key: str) -> DataFrame:
    """Replace ``old_key`` by ``new_key`` through a key mapping (inner join)."""
    joined = df.join(mapping.select(old_key, new_key), on=old_key, how="inner")
    rest = [c for c in df.columns if c != old_key]
    return joined.select(new_key, old_key, *rest)
