"""Licence scans against a plain search over word lists."""

import re

import pytest

from patrolstat.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    places = []
    for label, phrase in licenses.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


TEXTS = [
    None, "", "mit license", "MIT  License, Apache-License; (GNU) General\nPublic.License mit license mit license",
    "mit licenses the mitlicense m it license émit license mit licenseé", "general public license " * 300,
    "the general general public license", "日本 mit license 日本", "mit\x00license mit_license mit-license", "x" * 20_000 + " MIT license",
]


def test_base_places(spark, awkward, scratch):
    awkward.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"),
                        allowMissingColumns=True).write.parquet(str(scratch / "documents.parquet"))
    rows = spark.read.parquet(str(scratch / "documents.parquet")).select("doc_id", "text").collect()
    got = queries.op13_licenses(spark, str(scratch)).collect()
    assert sorted(map(repr, ((r.doc_id, *brute(r.text)) for r in rows))) == sorted(
        repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize("text,labels,permissive", [
    ("// SPDX-License-Identifier: MIT OR GPL-2.0-only\ncode", "gpl,mit", True),
    ("/* SPDX-License-Identifier: MIT AND GPL-2.0-only */", "gpl,mit", False),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl", True),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND (BSD-3-Clause OR GPL-3.0+)", "apache,bsd,gpl,mit", True),
    ("SPDX-License-Identifier: GPL-3.0+ OR MIT AND LGPL-2.1", "gpl,lgpl,mit", False),
    ("SPDX-License-Identifier: MIT OR OR Apache-2.0", "apache,mit", False),
    ('"license-expression": "LicenseRef-Own"', "licenseref-own", False),
    ("Licensed under the MIT License or, at your option, the Apache License.", "apache,mit", True),
    ("Licensed under the MIT License and the GNU General Public License", "gpl,mit", False),
    ("Covered by the GNU Lesser General Public License.", "gpl,lgpl", False),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc", False),
    ("Creative Commons Attribution ShareAlike 4.0", "cc-by-sa", False),
    ("no notice here, or and with", "", None),
])
def test_expressions(text, labels, permissive):
    got = licenses.Scanner().scan(text)
    assert (got["labels"], got["permissive"]) == (labels, permissive)


def test_strength_of_evidence():
    scan = licenses.Scanner().scan
    assert scan("SPDX-License-Identifier: MIT")["score"] == 1.0
    assert scan("Released under the MIT License.")["score"] == 0.9
    assert scan("we talked about the MIT License")["score"] == 0.5
    assert scan("SPDX-License-Identifier: MIT (")["score"] == 0.3


def test_postfix():
    assert licenses.to_postfix("a OR b AND c WITH d".split()) == ["a", "b", "c", "d", "with", "and", "or"]
    assert licenses.to_postfix(["(", "a", "or", "b", ")", "and", "c"]) == ["a", "b", "or", "c", "and"]
    for bad in ("a or", "or a", "( a", "a )", "a b", "", "( )", "a ( b )"):
        assert licenses.to_postfix(bad.split()) is None
    assert licenses.evaluate(licenses.to_postfix(["(", "a", "or", "b", ")", "with", "c"])) is None


def test_many_places_are_read_in_linear_time():
    got = licenses.Scanner().scan("mit license or " * 60_000)
    assert got["n_base"] == 60_000 and got["last_word"] == 179_997


def test_other_columns_and_empty_table(awkward, nothing):
    got = licenses.scan(awkward.withColumnRenamed("RANK", "Licence"))
    assert got.columns[-2:] == ["a b", "licence_"] and got.count() == awkward.count()
    assert licenses.scan(nothing).count() == 0
