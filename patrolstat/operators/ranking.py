"""Distributed row numbers: the place of every row in an order, per group, without one task that sees a group.

The rows are range-partitioned by (group, order), so a group that holds most of
the rows lies in many partitions; each partition is sorted and written once.
The sizes of the (partition, group) runs, at most partitions + groups of them,
give every run its offset.  Rows equal in all order columns are told apart by
their place in the input, so even a huge tie is dealt over partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patrolstat.session import written

_PARTITION_SHIFT = 33  # monotonically_increasing_id: partition number above, row number in the lower 33 bits


def ranked(df: DataFrame, order: list[Column], group: str | None = None, rank: str = "rank",
           total: str | None = None) -> DataFrame:
    """``df`` plus ``rank`` (long, from 0) in ``order`` within ``group`` and, if named, the group's ``total`` rows.

    ``group`` is a string column without nulls; no column of ``df`` may start
    with ``_rank_``.  An empty table gives no rows.
    """
    rows = df.withColumn("_rank_group", F.col(group) if group else F.lit("")).withColumn("_rank_tie", F.monotonically_increasing_id())
    keys = ["_rank_group", *order, "_rank_tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_rank_tie")
    rows = written(rows.withColumn("_rank_at", F.monotonically_increasing_id()))
    part = F.shiftright("_rank_at", _PARTITION_SHIFT)
    runs = rows.groupBy("_rank_group", part.alias("_rank_part")).agg(F.min("_rank_at").alias("_rank_first"), F.count("*").alias("_rank_n"))
    w = Window.partitionBy("_rank_group")
    before = F.coalesce(F.sum("_rank_n").over(w.orderBy("_rank_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = written(runs.select("_rank_group", "_rank_part", (before - F.col("_rank_first")).alias("_rank_shift"),
                           F.sum("_rank_n").over(w).alias("_rank_total")))
    placed = rows.withColumn("_rank_part", part).join(runs, ["_rank_group", "_rank_part"])
    extra = [F.col("_rank_total").alias(total)] if total else []
    return placed.select(*df.columns, (F.col("_rank_at") + F.col("_rank_shift")).alias(rank), *extra)
