"""The Merkle manifest against a plain tree built from all rows at once."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from patrolstat.llm import merkle, queries
from patrolstat.operators.ranking import ranked


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, n_chars):
    fields = (row.doc_id, row.source, row.lang, n_chars, row.text)
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def proof(tree, i, arity):
    """(left, right) siblings from the leaf up."""
    steps = []
    for layer in tree[:-1]:
        first = i // arity * arity
        steps.append(("".join(layer[first:i]), "".join(layer[i + 1:first + arity])))
        i //= arity
    return steps


def brute(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    trees, kept = {}, {}
    for lang, members in groups.items():
        members.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.n_chars)))
        kept[lang] = members
        trees[lang] = levels([leaf_of(r, r.n_chars) for r in members], arity)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    top = levels([trees[x][-1][0] for x in langs], arity)
    for n, lang in enumerate(langs):
        for i, r in enumerate(kept[lang]):
            steps = proof(trees[lang], i, arity) + proof(top, n, arity)
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
            folded = leaf_of(r, r.n_chars + tampered if r.n_chars is not None else None)
            for left, right in steps:
                folded = sha(left + folded + right)
            yield (r.doc_id, trees[lang][0][i], trees[lang][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), folded,
                   folded == top[-1][0])


def test_query_equals_a_plain_tree(spark, awkward, scratch):
    awkward.write.parquet(str(scratch / "documents.parquet"))
    got = queries.op11_merkle(spark, str(scratch)).collect()
    assert Counter(map(tuple, got)) == Counter(brute(awkward.collect()))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("arity,span", [(2, 1), (2, 3), (3, 2), (5, 10)])
def test_spans_and_arities_give_the_same_tree(awkward, arity, span):
    rows = awkward.withColumn("leaf", merkle.leaf_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]))
    span = min(span, 4)
    made = merkle.manifest(rows, "lang", ["doc_id"], "leaf", ["doc_id", "RANK", "a b"], arity, span)
    got = merkle.prove(made, made.leaves.select("grp", "rank", "row"))
    got = got.select("row.doc_id", "digest", "subroot", F.lit(made.root).alias("root"), merkle.proof_digest(F.col("proof")).alias("p"),
                     merkle.folded(F.col("digest"), F.col("proof")).alias("f")).collect()
    want = list(brute(awkward.collect(), arity))
    assert Counter(tuple(r)[:5] for r in got) == Counter(w[:5] for w in want)
    assert all(r.f == made.root for r in got)


def test_some_requests_and_a_wrong_one(spark, awkward):
    rows = awkward.withColumn("leaf", merkle.leaf_digest([F.col("doc_id"), F.col("text")]))
    made = merkle.manifest(rows, "lang", ["doc_id"], "leaf", arity=2, span=2)
    asked = spark.createDataFrame([("=en", 0, ("a",)), ("=en", 9, ("b",)), ("=en", 10**6, ("none",)), ("=lonely", 0, ("c",)),
                                   ("=no such", 0, ("d",))], "grp string, rank long, row struct<note:string>")
    got = {r.row.note: r for r in merkle.prove(made, asked).withColumn("f", merkle.folded(F.col("digest"), F.col("proof"))).collect()}
    assert set(got) == {"a", "b", "c"} and all(r.f == made.root for r in got.values())


def test_a_damaged_record_is_found(awkward):
    rows = awkward.withColumn("leaf", merkle.leaf_digest([F.col("doc_id"), F.col("text")]))
    made = merkle.manifest(rows, "lang", ["doc_id"], "leaf", arity=2, span=3)
    flipped = F.concat(F.translate(F.substring("children", 1, 64), "0123456789abcdef", "123456789abcdef0"),
                       F.expr("substring(children, 65)"))
    made.store[0] = made.store[0].withColumn("children", flipped)
    with pytest.raises(Exception, match="does not match its address"):
        merkle.prove(made, made.leaves.select("grp", "rank")).collect()


def test_empty(spark, nothing, scratch):
    nothing.write.parquet(str(scratch / "documents.parquet"))
    assert queries.op11_merkle(spark, str(scratch)).collect() == []


def test_ranks(spark, nothing):
    df = spark.range(500).selectExpr("if(id % 3 = 0, 'hot', string(id % 7)) as g", "int(id % 5) as v", "id").repartition(6)
    got = ranked(df, [F.col("v").desc()], "g", "place", "many").collect()
    for g in {r.g for r in got}:
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(len(mine))) and all(r.many == len(mine) for r in mine)
        assert [r.v for r in mine] == sorted((r.v for r in mine), reverse=True)
    assert sorted(r.rank for r in ranked(df, [F.col("id")]).collect()) == list(range(500))
    assert ranked(nothing.select("doc_id"), [F.col("doc_id")]).count() == 0
