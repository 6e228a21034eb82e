"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from patrolstat.session import ensure_checkpoint_dir

#: A word: a maximal run of characters other than space and the ASCII controls 9..13.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns into Python objects at a time.
MOST_BYTES = 4 << 20
#: Rows of an Arrow batch in jobs that end in :func:`cut`.
BATCH_ROWS = 4_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    The folder is shared by all executors, so a lost executor costs the tasks
    that ran on it and nothing else; the long lineage above ends here.  While the
    job runs, Arrow batches have at most ``BATCH_ROWS`` rows: each Python worker
    and its task hold a few batches of texts at a time.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that are no longer referenced.

    Its cleaner acts when the driver's JVM collects garbage; between the rounds
    of a long job that is worth asking for, since their results are written.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def parts(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = MOST_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``most_bytes`` in a column of texts or bytes; a longer value is alone.

    A batch has up to 10,000 rows whatever their length; what a task makes of one at a time is bounded by this.
    """
    for batch in batches:
        n = batch.num_rows
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast("int64"))
        run = (np.cumsum(sizes) - sizes) // most_bytes
        starts = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1, [n]))
        for a, b in zip(starts[:-1], starts[1:]):
            if b > a:
                yield batch.slice(int(a), int(b - a))


def discard(*written: DataFrame) -> None:
    """Empty the folders of frames made by :func:`cut`, once all that was read from them is written elsewhere."""
    for df in written:
        files = df.inputFiles()
        if files:
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])
