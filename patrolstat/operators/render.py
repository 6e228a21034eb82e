"""Rendering typed results to the labelled text records of the reports.

Rendering is the last, narrow step over an already aggregated result; the
typed columns stay the primary output (parquet), text is for people.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrolstat.functions.parsing import float_text
from patrolstat.functions.tables import N_SLOTS, SLOT_HOURS
from patrolstat.operators.aggregate import bucket_column

# --- FIXED VALUES: labels of the text records, in their order
BUCKET_LABELS = (
    ("vehicle", "Vehicle Incidents"), ("theft", "Theft Incidents"), ("drug", "Drug/Liquor Incidents"),
    ("weapon", "Incidents Involving Weapons"), ("sexual", "Sexual Incidents"), ("violent", "Violent Incidents/Suicide"),
    ("offense", "Incidents Involving Offenses"), ("report", "Reporting Incidents"), ("other", "Other Incidents"),
)
# --- end of fixed values


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def slot_text(i: int) -> Column:
    """``incidentCount(hour a - b): {n}; averageIncidentWeight(hour a - b): {m}; theftCounts(a - b): {t}``."""
    lo, hi = (i - 1) * SLOT_HOURS, i * SLOT_HOURS
    return F.concat(
        F.lit(f"incidentCount(hour {lo} - {hi}): {{"), _s(f"slot{i}_count"),
        F.lit(f"}}; averageIncidentWeight(hour {lo} - {hi}): {{"), float_text(f"slot{i}_mean_weight"),
        F.lit(f"}}; theftCounts({lo} - {hi}): {{"), _s(f"slot{i}_theft_count"), F.lit("}"))


def render_profile(profile: DataFrame, key: str, census_fields: list[tuple[str, str]],
                   out: str = "profile_text") -> DataFrame:
    """Slot profile rows -> ``(key,(censusData: {...},totalIncidentCount: n----slot1----...))``.

    ``census_fields`` lists (label, column) pairs; each renders as ``label: value``.
    Means render as 32-bit floats; an empty slot's mean renders ``NaN``.
    """
    census = F.concat_ws("; ", *[F.concat(F.lit(f"{label}: "), F.coalesce(_s(c), F.lit("null")))
                                 for label, c in census_fields])
    incidents = F.concat_ws("----", F.concat(F.lit("totalIncidentCount: "), _s("total_count")),
                            *[slot_text(i) for i in range(1, N_SLOTS + 1)])
    text = F.concat(F.lit("("), _s(key), F.lit(",(censusData: {"), census, F.lit("},"), incidents,
                    F.lit("))"))
    return profile.select(key, text.alias(out))


def render_buckets(counts: DataFrame, key: str | None = None, out: str = "bucket_text") -> DataFrame:
    """``bucket_counts`` rows -> ``Total Incidents: n; Vehicle Incidents: n; ...``; with ``key``, the rows' group beside it."""
    parts = [F.concat(F.lit("Total Incidents: "), _s("total_incidents"))]
    parts += [F.concat(F.lit(f"{label}: "), _s(bucket_column(name))) for name, label in BUCKET_LABELS]
    return counts.select(*([key] if key else []), F.concat_ws("; ", *parts).alias(out))
