"""Cleaning: missing-value normalisation, header removal, completeness, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrolstat.functions.parsing import (
    day_of,
    hour_of,
    minute_of,
    month_of,
    null_if_missing,
    percent_text,
    ratio_percent,
    safe_int,
)
from patrolstat.functions.categorize import severity_weight
from patrolstat.functions.tables import NO_ZIP, NULL_TEXT


def normalize_missing(df: DataFrame, columns: list[str],
                      markers: tuple[str, ...] = (NULL_TEXT,)) -> DataFrame:
    """Blank text and missing-value markers become SQL NULL in ``columns``."""
    return df.withColumns({c: null_if_missing(c, markers) for c in columns})


def drop_header_rows(df: DataFrame, header: dict[str, str]) -> DataFrame:
    """Drop rows equal to a header record (header lines found inside data).

    ``header`` maps column -> header text; a row is dropped only when every
    listed column equals its header text.
    """
    is_header = reduce(lambda a, b: a & b,
                       [F.col(c).eqNullSafe(F.lit(v)) for c, v in header.items()])
    return df.filter(~is_header)


def typed_incidents(raw: DataFrame) -> DataFrame:
    """Raw incident text fields -> typed incident columns.

    Expects string columns ``zip incident_date incident_time incident_year
    day_of_week incident_code category`` (others pass through).  Missing
    markers become NULL (zip ``00000`` included), numbers are parsed with
    ``try_cast`` so a bad value is NULL instead of an error, and the
    calendar parts are cut from the ``yyyy/MM/dd`` / ``HH:mm`` texts.
    """
    texts = ["incident_date", "incident_time", "day_of_week", "category", "incident_code",
             "incident_year"]
    df = normalize_missing(raw, texts)
    df = df.withColumn("zip", null_if_missing("zip", (NULL_TEXT, NO_ZIP)))
    return df.withColumns({
        "year": safe_int("incident_year"),
        "code": safe_int("incident_code"),
        "month": month_of("incident_date"),
        "day": day_of("incident_date"),
        "hour": hour_of("incident_time"),
        "minute": minute_of("incident_time"),
        "weight": severity_weight("category"),
    })


def usable_condition(zip_col: str = "zip", required: tuple[str, ...] = (
        "incident_date", "incident_time", "year", "month", "day", "hour", "minute",
        "day_of_week", "category", "code"),
        label: str = "weight") -> Column:
    """A row can train a model: a non-zero zip, all fields present, label != 0."""
    zip_ok = F.coalesce(safe_int(zip_col) != F.lit(0), F.lit(False))
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    label_ok = F.coalesce(F.col(label) != F.lit(0), F.lit(False))
    return zip_ok & present & label_ok


def completeness_filter(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """Keep complete rows only (see :func:`usable_condition`)."""
    return df.filter(usable_condition() if condition is None else condition)


def coverage(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """Total rows, usable rows and their ratio, counted in one pass."""
    cond = usable_condition() if condition is None else condition
    counts = df.agg(F.count(F.lit(1)).alias("total_records"),
                    F.count_if(cond).alias("usable_records"))
    pct = ratio_percent("usable_records", "total_records")
    return counts.select("total_records", "usable_records",
                         pct.alias("usable_percent"),
                         percent_text(pct).alias("usable_percent_text"))
