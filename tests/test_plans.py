"""Plan-shape checks behind the scale claims (read from ``explain``)."""

import re

import pytest

import __spark_entry__ as E
from patrolstat.plans import driver_queries as DQ

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"rf_predict", "dt_predict", "lr_predict", "lr_coefficients", "cv_scores", "batch_score",
                 "model_roundtrip", "rf_evaluation", "dt_stump", "forest_stump", "stump_evaluation", "cv_stump_scores",
                 "lr_class_shares", "raw_batch_score", "model_roundtrip_counts"}


def _plan(spark, capsys, name):
    df = E.queries()[name](spark, SF)
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(set(DQ.QUERIES) - MODEL_QUERIES))
def test_no_cross_join(spark, capsys, name):
    plan = _plan(spark, capsys, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_slot_profile_aggregates_before_join(spark, capsys):
    plan = _plan(spark, capsys, "slot_profile")
    tree = plan.split("\n\n")[0]
    # partial aggregate -> one exchange on the key -> final aggregate, below the join
    shuffles = re.findall(r"(?<!Broadcast)Exchange", tree)
    assert tree.count("HashAggregate") == 2 and len(shuffles) == 1
    join_line = next(i for i, l in enumerate(tree.splitlines()) if "Join" in l)
    agg_lines = [i for i, l in enumerate(tree.splitlines()) if "HashAggregate" in l]
    assert all(i > join_line for i in agg_lines)


def test_stitch_shuffles_once(spark, capsys):
    tree = _plan(spark, capsys, "segment_stitch").split("\n\n")[0]
    assert len(re.findall(r"(?<!Broadcast)Exchange", tree)) == 1


def test_wide_matrix_reads_its_rows_once(spark, capsys):
    tree = _plan(spark, capsys, "confusion_matrix_wide").split("\n\n")[0]
    assert tree.count("Scan parquet") == 1


def test_scan_prunes_columns(spark, capsys):
    plan = _plan(spark, capsys, "split_pick")
    schema = next(l for l in plan.splitlines() if l.startswith("ReadSchema"))
    assert "p_brand" not in schema and "p_name" in schema
