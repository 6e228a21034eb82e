"""Importance resampling against counts over plain strings; the selection against a sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patrolstat.llm import importance, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def features(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def brute(rows, target):
    s, t = Counter(), Counter()
    for r in rows:
        s.update(map(bucket, features(r.text)))
    for x in target:
        t.update(map(bucket, features(x)))
    many, few = float(sum(s.values()) + 10_000), float(sum(t.values()) + 10_000)
    out, eligible = [], []
    for i, r in enumerate(rows):
        f = features(r.text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * many / ((s[b] + 1) * few))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"42:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r.doc_id, len(f), weight, score, None])
        if len(words(r.text)) >= 20:
            eligible.append((-score, r.doc_id is None, r.doc_id or 0, i))
    eligible.sort()
    for n, x in enumerate(eligible[:5 * len(eligible) // 100]):
        out[x[-1]][4] = n + 1
    return Counter(map(tuple, out))


@pytest.fixture(scope="module")
def tables(spark, awkward, tmp_path_factory):
    folder = tmp_path_factory.mktemp("importance")
    awkward.write.parquet(str(folder / "documents.parquet"))
    target = ["running water stone", None, "", "mit license of the forest 日本 é", "cloud " * 50]
    spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), target


def test_query_equals_brute_force(spark, awkward, tables):
    folder, target = tables
    got = Counter(map(tuple, queries.op12_resample(spark, folder).collect()))
    assert got == brute(awkward.collect(), target)
    assert sum(1 for r in got if r[4] is not None) > 1


def test_long_texts_in_windows(spark, awkward, tables, monkeypatch):
    folder, target = tables
    monkeypatch.setattr(importance, "WINDOW", 64)
    assert Counter(map(tuple, queries.op12_resample(spark, folder).collect())) == brute(awkward.collect(), target)


def test_hashes_of_runs():
    text = "a bb ccc é日本 " + "long" * 40 + " z " + "q" * 70_000 + " end of it"
    hasher = importance.RunHasher(10_000)
    import pyarrow as pa
    (_, place, runs), = hasher.windows(pa.array([text]))
    got = Counter(x for order, run in enumerate(runs) for x in run[place >= order].tolist())
    assert got == Counter(map(bucket, features(text)))


@pytest.mark.parametrize("n,pivots", [(1, 3), (40, 1), (500, 3), (500, 31)])
def test_selection(spark, n, pivots):
    keys = [((i * 7919) % 13, i) for i in range(n)]
    df = spark.createDataFrame([(k,) for k in keys], "key struct<a:long,b:long>").repartition(5).cache()
    for k in {1, 2, n // 3, n, n + 1} - {0}:
        want = sorted(keys)[k - 1] if k <= n else None
        got = importance.smallest(df, "key", k, pivots)
        assert (got and tuple(got.values())) == want
    assert importance.smallest(df, "key", 0) is None


def test_other_columns_and_empty_tables(spark, awkward, nothing, tables):
    target = spark.read.parquet(f"{tables[0]}/benchmark.parquet")
    got = importance.resample(awkward, target)
    assert got.columns[:6] == ["doc_id", "lang", "source", "n_chars", "RANK", "a b"] and "rank_" in got.columns
    assert got.count() == awkward.count()
    assert importance.resample(nothing, target).count() == 0
    none = importance.resample(awkward, target.limit(0)).agg(F.count("rank_").alias("n")).first()
    assert none.n > 0


def test_draws_follow_the_weights():
    rng = np.random.default_rng(0)
    u = (rng.integers(0, 2**32, 200_000) + 0.5) / 2**32
    g = np.floor(-1000 * np.log(-np.log(u))).reshape(-1, 2)
    share = np.mean(g[:, 0] + 1000 * math.log(3) > g[:, 1])
    assert abs(share - 0.75) < 0.01
