"""Awkward rows that the tests of single operators share."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, RANK int, `a b` string"
WORDS = ("the of and running water stone bright river mountain leaf cloud seven green old walking under over forest light sound "
         "mit license apache general public é 日本").split()


@pytest.fixture(scope="module")
def awkward(spark):
    """Null ids, texts, groups; repeated rows; empty, short and long texts; clashing and odd column names."""
    rng = random.Random(11)
    rows = []
    for i in range(150):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 2, 3, 19, 20, 25, 60])))
        rows.append((i, text, rng.choice(["en", "fr", None, "", "é"]), f"s{i % 3}", len(text), i, "z"))
    rows += [rows[5], rows[5], rows[40], (None, rows[7][1], None, None, None, None, None), (None, None, "en", "s1", None, 3, "y"),
             (200, None, "lonely", "", 2**63 - 1, 0, ""), (201, "", "en", "s", 0, 0, ""), (202, "-", "en", "-", -5, 0, "-"),
             (203, "word " * 30_000, "en", "s", 1, 0, ""), (-4, "Big\x00MIT\tLicense. " * 40 + "x" * 5000, "en", "s", 1, 0, "")]
    return spark.createDataFrame(rows, DOCS).repartition(4).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
