import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, key, norm

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "zip" in df.columns and "slot1_mean_weight" in df.columns
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 36


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SMOKE)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=key)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    orows = sorted((tuple(norm(r[idx[c]]) for c in cols) for r in rel.fetchall()), key=key)
    assert srows == orows
