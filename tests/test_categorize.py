import pytest
from pyspark.sql import functions as F

from patrolstat.functions.categorize import hour_slot, is_theft, keyword_bucket, severity_weight
from patrolstat.functions.tables import SEVERITY_WEIGHTS


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first().r


# --- FIXED VALUES: the weights, stated once more so that the table is held against something
WEIGHTS = {
    "Non-Criminal": 1, "Other": 1, "Other Miscellaneous": 1, "Case Closure": 1,
    "Miscellaneous Investigation": 2, "Fraud": 2, "Forgery And Counterfeiting": 2, "Warrant": 2,
    "Traffic Violation Arrest": 2, "Gambling": 2, "Civil Sidewalks": 2, "Courtesy Report": 2,
    "Juvenile Offenses": 3, "Lost Property": 3, "Suspicious Occ": 3, "Suspicious": 3, "Vandalism": 3, "Recovered Vehicle": 3,
    "Vehicle Misplaced": 5, "Vehicle Impounded": 5,
    "Disorderly Conduct": 8, "Traffic Collision": 8, "Fire Report": 8, "Weapons Carrying Etc": 8,
    "Liquor Laws": 10, "Drug Offense": 10, "Drug Violation": 10, "Embezzlement": 10,
    "Motor Vehicle Theft": 14, "Stolen Property": 14, "Robbery": 14, "Motor Vehicle Theft?": 14, "Larceny Theft": 14,
    "Burglary": 14, "Malicious Mischief": 14,
    "Prostitution": 15, "Other Offenses": 15,
    "Arson": 18, "Offences Against The Family And Children": 18, "Family Offense": 18, "Missing Person": 18,
    "Weapons Offense": 18, "Weapons Offence": 18,
    "Suicide": 20, "Rape": 20, "Assault": 20, "Sex Offense": 20, "Homicide": 20,
    "Human Trafficking (A), Commercial Sex Acts": 20, "Human Trafficking, Commercial Sex Acts": 20,
}
THEFTS = {"Motor Vehicle Theft", "Stolen Property", "Robbery", "Motor Vehicle Theft?", "Larceny Theft", "Burglary"}
# --- end of fixed values


def test_tables_hold_these_values(spark):
    assert [(c, w) for w, cats in SEVERITY_WEIGHTS for c in cats] == list(WEIGHTS.items())
    df = spark.createDataFrame([(c, w, c in THEFTS) for c, w in [*WEIGHTS.items(), ("null", 0), (None, 0)]], "c string, w int, t boolean")
    assert df.filter((severity_weight("c") != F.col("w")) | (is_theft("c") != F.col("t"))).count() == 0


def test_stand_in_has_missing_categories(spark):
    from patrolstat.plans import driver_queries as DQ
    from patrolstat.plans import standins as S
    raw = S.raw_incidents(spark, "/root/testdata/sf0.001")
    assert raw.filter("category is null").count() > 0 and raw.filter("category = 'null'").count() > 0
    typed = DQ.incidents(spark, "/root/testdata/sf0.001").filter("category is null")
    assert typed.count() > raw.filter("category is null").count()
    assert {(r.weight) for r in typed.select("weight").distinct().collect()} == {0}


def test_every_table_entry_weighs_its_class(spark):
    rows = [(c, w) for w, cats in SEVERITY_WEIGHTS for c in cats]
    df = spark.createDataFrame(rows, "c string, w int")
    bad = df.filter(severity_weight("c") != F.col("w")).count()
    assert bad == 0


@pytest.mark.parametrize("value,expected", [
    ("Human Trafficking (A), Commercial Sex Acts", 20),   # quoted comma kept by real CSV parsing
    ("Malicious Mischief", 14),
    ("larceny theft", 0),                                  # exact, case-sensitive
    ("Unknown", 0),
    (None, 0),
])
def test_weight_cases(spark, value, expected):
    assert _one(spark, severity_weight, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("Human Trafficking, Commercial Sex Acts", "vehicle"),  # 'Trafficking' contains 'Traffic'
    ("Motor Vehicle Theft", "vehicle"),                     # vehicle rule comes first
    ("Larceny Theft", "theft"),
    ("Drug Offense", "drug"),
    ("Weapons Offense", "weapon"),
    ("Sex Offense", "sexual"),
    ("Malicious Mischief", "violent"),
    ("Other Offenses", "offense"),
    ("Fire Report", "report"),
    ("Non-Criminal", "other"),
    (None, "other"),
])
def test_bucket_first_match_wins(spark, value, expected):
    assert _one(spark, keyword_bucket, value) == expected


def test_theft_flag_excludes_malicious_mischief(spark):
    assert _one(spark, is_theft, "Malicious Mischief") is False
    assert _one(spark, is_theft, "Motor Vehicle Theft?") is True
    assert _one(spark, is_theft, None) is False


@pytest.mark.parametrize("hour,slot", [(0, 1), (5, 1), (6, 2), (11, 2), (12, 3), (17, 3), (18, 4),
                                       (23, 4), (24, None), (-1, None), (None, None)])
def test_hour_slot(spark, hour, slot):
    assert _one(spark, hour_slot, hour, "int") == slot
