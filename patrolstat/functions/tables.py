"""Fixed values that define the incident semantics.

Everything in this module is data, not logic: the tables are stated once,
in their natural order, and the expression builders in
:mod:`patrolstat.functions.categorize` turn them into Spark expressions
(and the oracle SQL builders turn them into SQL).
"""

from __future__ import annotations

# --- FIXED VALUES (must equal the reference for right results) -------------

# Severity weight per incident category; exact, case-sensitive match.
# Any category not listed weighs 0.
SEVERITY_WEIGHTS: tuple[tuple[int, tuple[str, ...]], ...] = (
    (1, ("Non-Criminal", "Other", "Other Miscellaneous", "Case Closure")),
    (2, ("Miscellaneous Investigation", "Fraud", "Forgery And Counterfeiting",
         "Warrant", "Traffic Violation Arrest", "Gambling", "Civil Sidewalks",
         "Courtesy Report")),
    (3, ("Juvenile Offenses", "Lost Property", "Suspicious Occ", "Suspicious",
         "Vandalism", "Recovered Vehicle")),
    (5, ("Vehicle Misplaced", "Vehicle Impounded")),
    (8, ("Disorderly Conduct", "Traffic Collision", "Fire Report",
         "Weapons Carrying Etc")),
    (10, ("Liquor Laws", "Drug Offense", "Drug Violation", "Embezzlement")),
    (14, ("Motor Vehicle Theft", "Stolen Property", "Robbery",
          "Motor Vehicle Theft?", "Larceny Theft", "Burglary",
          "Malicious Mischief")),
    (15, ("Prostitution", "Other Offenses")),
    (18, ("Arson", "Offences Against The Family And Children", "Family Offense",
          "Missing Person", "Weapons Offense", "Weapons Offence")),
    (20, ("Suicide", "Rape", "Assault", "Sex Offense", "Homicide",
          "Human Trafficking (A), Commercial Sex Acts",
          "Human Trafficking, Commercial Sex Acts")),
)
UNKNOWN_WEIGHT = 0

# Keyword buckets: the first rule with a keyword contained in the category
# wins (case-sensitive substring match); no match -> "other".
BUCKET_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("vehicle", ("Vehicle", "Traffic")),
    ("theft", ("Theft", "Stolen", "Robbery", "Burglary", "Embezzlement")),
    ("drug", ("Drug", "Liquor")),
    ("weapon", ("Weapon",)),
    ("sexual", ("Rape", "Sex", "Trafficking", "Prostitution")),
    ("violent", ("Assault", "Suicide", "Homicide", "Malicious")),
    ("offense", ("Offense", "Offence")),
    ("report", ("Report",)),
)
OTHER_BUCKET = "other"

# Categories counted as thefts in the slot profile (Malicious Mischief is
# not one of them although it weighs 14).
THEFT_CATEGORIES: tuple[str, ...] = (
    "Motor Vehicle Theft", "Stolen Property", "Robbery",
    "Motor Vehicle Theft?", "Larceny Theft", "Burglary",
)

# Hour-of-day slots: [0,6) [6,12) [12,18) [18,24) -> 1..4.
SLOT_HOURS = 6
N_SLOTS = 4

# Fixed weekday universe for dummy columns.
WEEKDAYS: tuple[str, ...] = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
    "Sunday",
)

# Missing-value markers used by the raw incident text.
NULL_TEXT = "null"
NO_ZIP = "00000"

# Column layout of the fixed-width census geography record
# (0-based, end exclusive) and of the segment records.
CENSUS_GEO_LOGRECNO = (18, 25)
CENSUS_GEO_ZCTA5 = (160, 165)
CENSUS_SEGMENT_LOGRECNO = (15, 22)
CENSUS_SEGMENT_PAYLOAD_START = 23
CENSUS_SEGMENT_COUNT = 76

# --- end of fixed values ----------------------------------------------------


def all_weighted_categories() -> list[str]:
    """Every category of the severity table, in table order."""
    return [c for _, cats in SEVERITY_WEIGHTS for c in cats]


def bucket_names() -> list[str]:
    """Bucket names in rule order, then the fallback bucket."""
    return [b for b, _ in BUCKET_RULES] + [OTHER_BUCKET]
