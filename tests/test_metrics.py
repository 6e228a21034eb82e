import random

import pytest

from patrolstat.operators import metrics as ME


@pytest.fixture(scope="module")
def pairs(spark):
    rnd = random.Random(3)
    labels = [1.0, 2.0, 3.0, 5.0, 14.0, 20.0]
    rows = []
    for _ in range(600):
        lab = rnd.choice(labels)
        pred = lab if rnd.random() < 0.5 else rnd.choice(labels[:-1] + [8.0])   # 8 never a true label
        rows.append((pred, lab))
    rows.append((14.0, 20.0))
    return spark.createDataFrame(rows, "prediction double, label double")


def test_against_spark_multiclass_metrics(spark, pairs):
    from pyspark.mllib.evaluation import MulticlassMetrics

    mm = MulticlassMetrics(pairs.rdd.map(lambda r: (r.prediction, r.label)))
    per = {r.label: r for r in ME.label_metrics(pairs).collect()}
    assert sorted(per) == sorted(mm.call("labels"))
    for lab, r in per.items():
        assert r.precision == pytest.approx(mm.precision(lab), abs=1e-12)
        assert r.recall == pytest.approx(mm.recall(lab), abs=1e-12)
        assert r.fpr == pytest.approx(mm.falsePositiveRate(lab), abs=1e-12)
        assert r.f1 == pytest.approx(mm.fMeasure(lab, 1.0), abs=1e-12)
    s = ME.summary_metrics(pairs).first()
    assert s.accuracy == pytest.approx(mm.accuracy, abs=1e-12)
    assert s.weighted_recall == pytest.approx(mm.weightedRecall, abs=1e-12)
    assert s.n == 601


def test_confusion_matrix_shape(spark, pairs):
    wide = ME.confusion_matrix(pairs).collect()
    labels = [r.label for r in wide]
    assert labels == sorted(labels) and 8.0 in labels           # a label that is only predicted has a row
    assert all(r.k == labels for r in ME.confusion_matrix(pairs).selectExpr("map_keys(counts) as k").collect())
    support = {r.label: r.support for r in ME.label_metrics(pairs).collect()}
    assert all(sum(r.counts.values()) == support.get(r.label, 0) for r in wide)
    cells = {(r.label, p): n for r in wide for p, n in r.counts.items() if n}
    assert cells == {(r.label, r.prediction): r["count"] for r in ME.confusion_counts(pairs).collect()}
    long = ME.confusion_counts(pairs).collect()
    assert sum(r["count"] for r in long) == 601


def test_wide_matrix_of_awkward_rows(spark, pairs):
    df = spark.createDataFrame([(None, 1.0), (2.0, None), (2.0, 2.0)], "prediction double, label double")
    assert {r.label: r.counts for r in ME.confusion_matrix(df).collect()} == {1.0: {1.0: 0, 2.0: 0}, 2.0: {1.0: 0, 2.0: 1}}
    assert ME.confusion_matrix(pairs.limit(0)).collect() == []


def test_precision_zero_when_never_predicted(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "prediction double, label double")
    per = {r.label: r for r in ME.label_metrics(df).collect()}
    assert per[2.0].precision == 0.0 and per[2.0].f1 == 0.0
    assert per[1.0].precision == 0.5 and per[1.0].recall == 1.0


def test_report_sections(spark, pairs):
    secs = {r.section for r in ME.evaluation_report(pairs).collect()}
    assert {"precision", "recall", "fpr", "f1", "support", "accuracy", "majority_share", "confusion"} <= secs
