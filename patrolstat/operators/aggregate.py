"""Aggregations: dedup, slot profile, keyword buckets, first-seen, union.

Every aggregate here is a declarative Spark aggregate (count_if, avg, min on
structs), so the physical plan is a partial HashAggregate before the shuffle
and a final one after it: a key that holds a third of all rows still ships
only one partial row per map task, and no group is ever materialised as a
list or string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrolstat.functions.categorize import hour_slot, is_theft, keyword_bucket, severity_weight
from patrolstat.functions.tables import BUCKET_RULES, N_SLOTS, OTHER_BUCKET, bucket_names


def dedup_keep_first(df: DataFrame, key: str | list[str], order_by: str | list[str]) -> DataFrame:
    """Keep one row per key: the row with the smallest ``order_by`` values.

    Ties on ``order_by`` are broken by the remaining columns, so the survivor
    is deterministic (unlike ``dropDuplicates``).  Implemented as ``min`` over
    a struct, which aggregates partially on the map side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in df.columns if c not in keys])
            .select(*df.columns))


def slot_columns() -> list[str]:
    """Output column names of :func:`slot_aggregates`, in order."""
    cols = ["total_count"]
    for i in range(1, N_SLOTS + 1):
        cols += [f"slot{i}_count", f"slot{i}_mean_weight", f"slot{i}_theft_count"]
    return cols


def slot_aggregates(slot: Column | str = "_slot", weight: Column | str = "_weight",
                    theft: Column | str = "_theft") -> list[Column]:
    """Aggregate expressions of the per-slot profile over precomputed columns.

    For each 6-hour slot: incident count, mean severity weight (NULL for an
    empty slot) and theft count; plus the total over all slots.  Rows whose
    hour is missing or out of range have a NULL slot and are not counted.
    """
    slot = F.col(slot) if isinstance(slot, str) else slot
    weight = F.col(weight) if isinstance(weight, str) else weight
    theft = F.col(theft) if isinstance(theft, str) else theft
    aggs = [F.count(slot).alias("total_count")]
    for i in range(1, N_SLOTS + 1):
        in_slot = slot == F.lit(i)
        aggs += [
            F.count_if(in_slot).alias(f"slot{i}_count"),
            F.avg(F.when(in_slot, weight)).alias(f"slot{i}_mean_weight"),
            F.count_if(in_slot & theft).alias(f"slot{i}_theft_count"),
        ]
    return aggs


def slot_profile(incidents: DataFrame, profile: DataFrame, key: str,
                 hour: str = "hour", category: str = "category") -> DataFrame:
    """Per-key incident profile by 6-hour slot, inner-joined to ``profile``.

    Slot, weight and theft flag are computed once per incident in a narrow
    projection; the incidents are then aggregated to one row per key
    *before* the join, so the join moves one row per key instead of every
    incident.  Keys missing on either side vanish exactly as in an inner
    join of profile and incidents followed by a per-key reduction.
    ``profile`` must hold one row per key (see :func:`dedup_keep_first`).
    """
    per_key = (incidents.select(key, hour_slot(hour).alias("_slot"),
                                severity_weight(category).alias("_weight"),
                                is_theft(category).alias("_theft"))
               .groupBy(key).agg(*slot_aggregates()))
    return profile.join(per_key, on=key, how="inner")


def bucket_column(name: str) -> str:
    return f"{name}_incidents"


def bucket_counts(df: DataFrame, category: str = "category",
                  group_by: str | list[str] | None = None) -> DataFrame:
    """Incident count per keyword bucket, city-wide or per group.

    One pass: the bucket is an expression and each count is a ``count_if``,
    so a global count moves one partial row per task and a grouped count one
    partial row per (task, group).
    """
    groups = [] if group_by is None else ([group_by] if isinstance(group_by, str) else list(group_by))
    # The bucket is computed once per row in a projection; each count then
    # compares that column (the optimizer does not re-inline the CASE).
    src = df.select(*groups, keyword_bucket(category).alias("_bucket"))
    aggs = [F.count(F.lit(1)).alias("total_incidents")]
    aggs += [F.count_if(F.col("_bucket") == F.lit(name)).alias(bucket_column(name)) for name in bucket_names()]
    return src.groupBy(*groups).agg(*aggs) if groups else src.agg(*aggs)


def bucket_shares(counts: DataFrame, group_by: str | list[str] | None = None) -> DataFrame:
    """Long form of :func:`bucket_counts` with each bucket's share of the total."""
    groups = [] if group_by is None else ([group_by] if isinstance(group_by, str) else list(group_by))
    names = bucket_names()
    long = counts.unpivot(
        ids=groups + ["total_incidents"],
        values=[bucket_column(n) for n in names],
        variableColumnName="bucket_col",
        valueColumnName="incidents",
    )
    return long.select(
        *groups,
        F.regexp_replace("bucket_col", "_incidents$", "").alias("bucket"),
        "incidents",
        "total_incidents",
        F.try_divide(F.col("incidents").cast("double"), F.col("total_incidents").cast("double")).alias("share"),
    )


def distinct_first_seen(df: DataFrame, value: str, order_by: str) -> DataFrame:
    """Distinct values with the position where each is first seen, in that order.

    ``order_by`` states what "first" means (a line number, an event id);
    the result is sorted by it with a distributed range sort.
    """
    return (df.groupBy(value).agg(F.min(order_by).alias("first_seen"))
            .orderBy("first_seen", value))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union by column name (no dedup), as when two input files are merged."""
    return reduce(lambda a, b: a.unionByName(b), frames)


__all__ = [
    "BUCKET_RULES", "OTHER_BUCKET", "bucket_column", "bucket_counts", "bucket_shares",
    "dedup_keep_first", "distinct_first_seen", "slot_aggregates", "slot_columns",
    "slot_profile", "union_sources",
]
