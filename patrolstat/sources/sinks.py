"""Sinks: typed parquet, rendered text, evaluation reports, previews, models.

Writes are distributed (one file per partition); nothing is gathered on the
driver.  Models are saved as whole ``PipelineModel`` objects so that the
preprocessing travels with the classifier.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Typed output (keeps columns and types for the next job)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text(df: DataFrame, path: str, rendered: Column | str, mode: str = "overwrite") -> None:
    """One rendered line per row (the human-readable form of a result)."""
    c = F.col(rendered) if isinstance(rendered, str) else rendered
    df.select(c.alias("value")).write.mode(mode).text(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tidy evaluation report (section, label, value) as CSV with a header."""
    report.write.mode(mode).option("header", True).csv(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows as a DataFrame (``show`` prints; this composes)."""
    return df.limit(n)


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (overwrites)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a pipeline saved with :func:`save_model`."""
    return PipelineModel.load(path)
