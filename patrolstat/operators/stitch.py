"""Segment stitch: records split over N numbered segments, joined back per key.

The chain of N-1 inner joins on the record key is one grouping here: narrow
(segment, payload) rows are shuffled once, by key, and sorted per key, at most N
of them; the check for repeated pairs groups by more than the key and so needs no
second shuffle.  A key is kept only when every segment 1..N is present, which is what
the inner-join chain means.  A repeated (key, segment) pair is an error in the
input (a join chain would multiply the record) and fails the job, by name.
Segments outside 1..N are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def segment_stitch(segments: DataFrame, key: str, segment: str, payload: str,
                   n_segments: int, sep: str = ",", out: str = "record") -> DataFrame:
    """(key, segment, payload) rows -> (key, record) with payloads in segment order.

    Every payload is followed by ``sep`` (the record is ``p1,p2,...,pN,``).
    """
    rows = segments.filter(F.col(segment).between(1, n_segments)).select(
        key, F.struct(F.col(segment).alias("s"), F.coalesce(F.col(payload), F.lit("")).alias("p")).alias("_sp"))
    rows = rows.repartition(key)  # both groupings below need no more than this
    # repeated pairs are found by counts, so they never pile up in a list
    per_pair = rows.groupBy(key, F.col("_sp.s").alias("_s")).agg(F.count(F.lit(1)).alias("_n"), F.first("_sp").alias("_sp"))
    one = F.when(F.col("_n") == 1, F.col("_sp")).otherwise(F.raise_error(F.concat(
        F.lit("segment "), F.col("_s").cast("string"), F.lit(" is repeated for record "), F.col(key).cast("string"))))
    per_key = per_pair.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("_all")).filter(F.size("_all") == n_segments)
    record = F.concat(F.array_join(F.transform("_all", lambda x: x["p"]), sep), F.lit(sep))
    return per_key.select(key, record.alias(out))
