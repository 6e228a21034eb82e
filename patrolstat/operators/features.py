"""Feature engineering with Spark ML transformers and built-in expressions."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrolstat.functions.tables import WEEKDAYS
from patrolstat.operators.ranking import ranked

# Columns the models use, in assembly order after the weekday vector.
NUMERIC_FEATURES = ("zipcode", "month", "date", "hour", "minute", "year")


def frequency_indexer(col: str, out: str, keep_invalid: bool = True) -> StringIndexer:
    """Index by descending frequency (ties alphabetical).

    With ``keep_invalid`` values unseen at fit time get one extra index
    instead of failing the job (needed when scoring new rows).
    """
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc",
                         handleInvalid="keep" if keep_invalid else "error")


def frequency_index(df: DataFrame, col: str, out: str, keep_invalid: bool = True) -> DataFrame:
    """Fit and apply :func:`frequency_indexer` (one counting pass over ``col``)."""
    return frequency_indexer(col, out, keep_invalid).fit(df).transform(df)


def frequency_ranks(df: DataFrame, col: str) -> DataFrame:
    """``value, index, count`` of every value of ``col``: index by descending count, ties by the value's text.

    What :func:`frequency_indexer` gathers on the driver, as a table: values are counted with partial
    sums, sorted by range over all partitions and numbered by the partitions' offsets, so the
    column may have any number of values.  NULL is no value.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("count"))
    return ranked(counts, [F.col("count").desc(), F.col("value")], rank="index") \
        .select("value", F.col("index").cast("double").alias("index"), "count")


def apply_ranks(df: DataFrame, ranks: DataFrame, col: str, out: str, keep_invalid: bool = True) -> DataFrame:
    """``df`` plus the index of ``col`` in ``ranks``; NULL and unseen values get one extra index or fail the job.

    A shuffled join unless the planner finds the ranks small; a hot value's rows are split by the skew
    handling of adaptive execution.
    """
    index = ranks.select(F.col("value").alias("_value"), F.col("index").alias(out))
    text = F.col(col).cast("string")
    found = df.join(index, text.eqNullSafe(F.col("_value")), "left").drop("_value")
    if keep_invalid:
        extra = ranks.agg(F.count("*").cast("double")).scalar()
        return found.withColumn(out, F.coalesce(F.col(out), extra))
    return found.withColumn(out, F.coalesce(F.col(out), F.raise_error(
        F.concat(F.lit(f"no index for the value of {col}: "), F.coalesce(text, F.lit("NULL")))).cast("double")))


def frequency_index_distributed(df: DataFrame, col: str, out: str, keep_invalid: bool = True) -> DataFrame:
    """What :func:`frequency_index` gives, for a column with any number of values; no value reaches the driver."""
    return apply_ranks(df, frequency_ranks(df, col), col, out, keep_invalid)


def one_hot(df: DataFrame, index_col: str, out: str, drop_last: bool = True,
            keep_invalid: bool = False) -> DataFrame:
    """One-hot vector of an index column (last category dropped by default)."""
    enc = OneHotEncoder(inputCols=[index_col], outputCols=[out], dropLast=drop_last,
                        handleInvalid="keep" if keep_invalid else "error")
    return enc.fit(df).transform(df)


def weekday_dummies(df: DataFrame, col: str, universe: tuple[str, ...] = WEEKDAYS) -> DataFrame:
    """One 0/1 int column per weekday of a fixed universe (absent days stay 0)."""
    return df.withColumns({d: F.coalesce((F.col(col) == F.lit(d)).cast("int"), F.lit(0)) for d in universe})


def assemble(df: DataFrame, inputs: list[str], out: str = "features") -> DataFrame:
    """Concatenate numeric and vector columns into one feature vector."""
    return VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep").transform(df)


def feature_stages(weekday: str = "dayOfWeek", numeric: tuple[str, ...] = NUMERIC_FEATURES,
                   out: str = "features") -> list:
    """Pipeline stages: weekday index -> one-hot -> assembly with the numeric columns."""
    return [
        frequency_indexer(weekday, f"{weekday}Index"),
        OneHotEncoder(inputCols=[f"{weekday}Index"], outputCols=[f"{weekday}Vec"], dropLast=True,
                      handleInvalid="keep"),
        VectorAssembler(inputCols=[f"{weekday}Vec", *numeric], outputCol=out, handleInvalid="keep"),
    ]


def feature_pipeline(weekday: str = "dayOfWeek", numeric: tuple[str, ...] = NUMERIC_FEATURES) -> Pipeline:
    return Pipeline(stages=feature_stages(weekday, numeric))


def key_split(df: DataFrame, key: str, train_percent: int = 70, method: str = "hash",
              out: str = "split") -> DataFrame:
    """Deterministic train/test label per row from its key, independent of partitioning.

    ``hash``: ``pmod(xxhash64(key), 100)``; ``modular``: ``pmod(pmod(key, 100) * 19 + 13, 100)``
    (integer keys; reproducible in any SQL engine).
    """
    if method == "hash":
        bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(100))
    elif method == "modular":
        bucket = F.pmod(F.pmod(F.col(key), F.lit(100)) * F.lit(19) + F.lit(13), F.lit(100))
    else:
        raise ValueError(method)
    return df.withColumn(out, F.when(bucket < F.lit(train_percent), F.lit("train")).otherwise(F.lit("test")))


def random_split(df: DataFrame, train_fraction: float = 0.7, seed: int = 12345) -> tuple[DataFrame, DataFrame]:
    """Seeded random split (depends on the input's partitioning, unlike :func:`key_split`)."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test


def indexed_one_hot_stages(columns: list[str], out: str = "features") -> list:
    """Every column indexed by frequency, one-hot encoded, then assembled.

    Indexing first makes each vector as wide as the number of values that
    occur, not as the largest raw value (a raw zip code as a one-hot index
    would make a vector ~94,000 wide).
    """
    idx = [frequency_indexer(c, f"{c}_idx") for c in columns]
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns],
                        dropLast=True, handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}_vec" for c in columns], outputCol=out, handleInvalid="keep")
    return [*idx, enc, asm]
