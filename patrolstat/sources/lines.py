"""Line numbers of files, counted where the splits are read.

A file's lines keep their order inside a split, and a split is known by its file
and the byte it starts at (``_metadata``).  So a line's number is the number of
lines in the splits before its own plus its place inside the split: the lines of
each split are counted once, the counts are summed up in the order (path, start),
and every line adds its split's sum.  The counts are one row per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patrolstat.session import written

# Splits whose counts are sent to every task (about 200 bytes each); beyond, a shuffled join.
MAX_BROADCAST_SPLITS = 100_000


def with_line_numbers(rows: DataFrame, line: str = "line", file: str | None = None,
                      materialize: bool = True) -> DataFrame:
    """``rows`` as a file reader gave them plus ``line``: their number, from 0, files in order of their paths.

    With ``file`` the numbers start again in every file, and that column holds its path.  Header lines that
    the reader dropped are not counted.

    How files are cut into splits follows from settings and cores, so two scans may differ.
    ``materialize`` writes the rows once and numbers what was written.  Without it the files are
    scanned twice and nothing is written; should the scans be cut differently, the job fails and
    says so (``spark.sql.leafNodeDefaultParallelism`` fixes the cut).
    """
    names = rows.columns
    at = rows.select("*", F.col("_metadata.file_path").alias("_line_file"), F.col("_metadata.file_block_start").alias("_line_split"),
                     F.monotonically_increasing_id().alias("_line_id"))
    if materialize:
        at = written(at)
    split = ["_line_file", "_line_split"]
    counts = at.groupBy(*split).agg(F.min("_line_id").alias("_line_first"), F.count("*").alias("_line_n"))
    # one row per split: a file's splits in one task, then one row per file
    in_file = Window.partitionBy("_line_file").orderBy("_line_split")
    per_file = counts.groupBy("_line_file").agg(F.sum("_line_n").alias("_line_of_file"))
    over_files = Window.orderBy("_line_file").rowsBetween(Window.unboundedPreceding, -1)
    files = per_file.select("_line_file", F.coalesce(F.sum("_line_of_file").over(over_files), F.lit(0)).alias("_line_before_file"))
    counts = counts.withColumn("_line_before", F.coalesce(F.sum("_line_n").over(
        in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).join(files, "_line_file")
    before = F.col("_line_before") if file else F.col("_line_before") + F.col("_line_before_file")
    counts = written(counts.select(*split, "_line_n", (before - F.col("_line_first")).alias("_line_shift")))
    if counts.count() <= MAX_BROADCAST_SPLITS:
        counts = F.broadcast(counts)
    found = at.join(counts, split, "inner" if materialize else "left")
    shift = F.col("_line_shift")
    if not materialize:
        shift = F.coalesce(shift, F.raise_error("the second scan cut the files differently").cast("long"))
    extra = [F.col("_line_file").alias(file)] if file else []
    return found.select(*names, (F.col("_line_id") + shift).alias(line), *extra)


def in_file_order(rows: DataFrame, **options) -> DataFrame:
    """``rows`` of a file reader, sorted as they stand in the files (a distributed range sort)."""
    numbered = with_line_numbers(rows, line="_line_no", **options)
    return numbered.orderBy("_line_no").drop("_line_no")
