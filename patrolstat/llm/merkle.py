"""Merkle manifest of a dataset: a content-addressed DAG and membership proofs by descent.

Every row has a leaf digest of its fields.  The leaves of one group (in their
order) are folded ``arity`` at a time until one node is left, the group's root;
the group roots are folded in the same way to the root of the dataset.

The manifest stores records ``digest -> children``.  A record spans up to
``SPAN`` levels: its children are the digests that many levels below, and the
levels between follow from them, so a reader can check a record against its own
address.  Equal records are stored once.

A proof request is a (group, rank).  Requests descend from the root: the digits
of the rank in base ``arity`` choose a child at each node, the unselected
children are collected, and the collected segment is reversed in front of the
path of the node above, since a proof is folded from the leaf up.  Only the
distinct prefixes of the requested ranks descend, a span at a time: the work is
one row per record opened, plus one per request at the last step.

Digests are SHA-256 in lowercase hex, of the concatenated hex texts of the
inputs.  Groups are ordered null first, then by their UTF-8 bytes; leaves by the
given order, null first, then by digest.

Defined results: a null field is written ``-``, any other as its UTF-8 byte
count, ``:`` and its value, so no two rows of fields give one input; empty and
long texts are hashed whole; repeated rows are leaves of their own next to each
other; a null group is a group; a group of one row has its leaf as its root; an
empty table has no root (None) and no proofs; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patrolstat.operators.ranking import ranked

from .common import cut

ARITY = 2
SPAN = 10
_HEX = 64
PROOF = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def field(value: Column) -> Column:
    """A field of a leaf: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def height(n: Column, arity: int) -> Column:
    """Levels above ``n`` nodes: the smallest ``h`` with ``arity ** h >= n`` (counted in whole numbers)."""
    powers, p = [], 1
    while p < 1 << 62:
        powers.append(p)
        p *= arity
    return F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < n))


def _fold(layer: list[str], arity: int) -> list[str]:
    return [hashlib.sha256("".join(layer[i:i + arity]).encode()).hexdigest() for i in range(0, len(layer), arity)]


@dataclass
class Manifest:
    """``root`` (None for an empty dataset); ``leaves``: ``grp``, ``rank`` (from 0), ``total``, ``digest`` and
    the kept columns in the struct ``row`` (so that their names clash with nothing);
    ``subroots``: ``grp, digest`` (the group's root), ``spans`` (records on a path in the group) and its place among the groups;
    ``store[t]`` and ``upper[t]``: records ``digest, levels, children`` at ``t`` spans above the leaves and the group roots."""

    root: str | None
    leaves: DataFrame
    subroots: DataFrame
    store: list[DataFrame]
    upper: list[DataFrame]
    arity: int
    span: int


def _records(nodes: DataFrame, arity: int, span: int) -> DataFrame:
    """One level of records over ``grp, rank, total, digest``: the nodes ``span`` levels up (fewer at the top)."""
    width = arity ** span

    def up(block: pa.Table) -> pa.Table:
        at = sorted(zip(block["rank"].to_pylist(), block["digest"].to_pylist()))
        total = block["total"][0].as_py()
        children = [d for _, d in at]
        layer, levels = children, 0
        while levels < span and arity ** levels < total:
            layer, levels = _fold(layer, arity), levels + 1
        return pa.table({"grp": [block["grp"][0].as_py()], "rank": [at[0][0] // width], "total": [-(-total // width)],
                         "digest": layer, "levels": pa.array([levels], pa.int32()), "children": ["".join(children)]})

    return nodes.withColumn("block", F.expr(f"rank div {width}")).groupBy("grp", "block").applyInArrow(
        up, "grp string, rank long, total long, digest string, levels int, children string")


def _forest(nodes: DataFrame, arity: int, span: int) -> tuple[list[DataFrame], DataFrame]:
    """The records of every group's tree, lowest first, and the roots: ``grp, digest, spans``."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    store, tops, spans = [], [], 0
    while most > 1:
        tops.append(nodes.filter("total = 1").select("grp", "digest", F.lit(spans).alias("spans")))
        made = cut(_records(nodes.filter("total > 1"), arity, span))
        store.append(made.select("digest", "levels", "children").dropDuplicates(["digest"]))
        nodes, spans, most = made.select("grp", "rank", "total", "digest"), spans + 1, -(-most // arity ** span)
    roots = nodes.filter("total = 1").select("grp", "digest", F.lit(spans).alias("spans"))
    for t in tops:
        roots = roots.unionByName(t)
    return store, roots


def manifest(rows: DataFrame, group: str, order: list[str], digest: str, keep: list[str] = [], arity: int = ARITY,
             span: int = SPAN) -> Manifest:
    """Builds the DAG over ``rows``; ``keep`` names columns to find again in ``leaves``."""
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null is before every "=..."
    keyed = rows.select(key.alias("grp"), F.col(digest).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in order]).alias("place"),
                        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row"))
    leaves = ranked(keyed, [F.col("place").asc_nulls_first(), F.col("digest")], "grp", "rank", "total").drop("place")
    store, roots = _forest(leaves.drop("row"), arity, span)
    subroots = cut(ranked(cut(roots).withColumnRenamed("grp", "name").withColumn("grp", F.lit("")),
                          [F.col("name")], "grp", "rank", "total"))
    upper, top = _forest(subroots.select("grp", "rank", "total", "digest"), arity, span)
    root = top.first()
    return Manifest(root.digest if root else None, leaves, subroots, store, upper, arity, span)


def _descend(store: list[DataFrame], tops: DataFrame, requests: DataFrame, arity: int, span: int) -> DataFrame:
    """``requests`` (``grp, rank`` and more) with ``digest`` (reached), ``proof`` (leaf first), ``top``.

    ``tops``: ``grp, digest, spans, proof, top`` where each group's descent starts.
    """
    width = arity ** span
    kept = requests.columns
    carried = ["grp", "at", "digest", "proof", "top"]

    def walk(wanted: pa.Table, opened: pa.Table) -> pa.Table:
        reached, sides, starts, at = [], ([], []), [0], []
        if opened.num_rows and wanted.num_rows:
            levels, children = opened["levels"][0].as_py(), opened["children"][0].as_py()
            above = opened["proof"][0].as_py()
            layers = [[children[i:i + _HEX] for i in range(0, len(children), _HEX)]]
            for _ in range(levels):
                layers.append(_fold(layers[-1], arity))
            if layers[-1] != [opened["digest"][0].as_py()]:
                raise ValueError(f"record {opened['digest'][0]} does not match its address")
            for row, rank in enumerate(wanted["rank"].to_pylist()):
                below = rank % width
                if below >= len(layers[0]):
                    continue  # no such leaf
                segment, node = [], 0
                for level in range(levels - 1, -1, -1):
                    first, digit = node * arity, below // arity ** level % arity
                    run = layers[level][first:first + arity]
                    segment.append(("".join(run[:digit]), "".join(run[digit + 1:])))
                    node = first + digit
                reached.append(layers[0][node])
                at.append(row)
                for left, right in reversed(segment):
                    sides[0].append(left)
                    sides[1].append(right)
                for step in above:
                    sides[0].append(step["left"])
                    sides[1].append(step["right"])
                starts.append(len(sides[0]))
        steps = pa.StructArray.from_arrays([pa.array(s, pa.string()) for s in sides], ["left", "right"])
        out = wanted.select(out_columns).take(pa.array(at, pa.int64()))
        top = opened["top"][0].as_py() if opened.num_rows else None
        return (out.append_column("digest", pa.array(reached, pa.string()))
                .append_column("proof", pa.ListArray.from_arrays(pa.array(starts, pa.int32()), steps))
                .append_column("top", pa.array([top] * len(at), pa.string())))

    frontier = None
    for t in range(len(store) - 1, -1, -1):
        entered = tops.filter(F.col("spans") == t + 1).select("grp", F.lit(0).cast("long").alias("at"), "digest", "proof", "top")
        frontier = entered if frontier is None else frontier.unionByName(entered)
        opened = frontier.join(store[t], "digest").select(*carried, "levels", "children")
        if t:
            wanted = requests.select("grp", F.expr(f"rank div {width ** t}").alias("rank")).distinct()
        else:
            wanted = requests
        out_columns = list(wanted.columns)
        schema = T.StructType([*wanted.schema.fields, T.StructField("digest", T.StringType()), T.StructField("proof", PROOF),
                               T.StructField("top", T.StringType())])
        found = (wanted.withColumn("block", F.expr(f"rank div {width}")).groupBy("grp", "block")
                 .cogroup(opened.groupBy("grp", "at")).applyInArrow(walk, schema))
        frontier = cut(found.withColumnRenamed("rank", "at").select(*carried)) if t else found
    # a group of one row has no record: its root is the leaf
    alone = requests.filter("rank = 0").join(tops.filter("spans = 0"), "grp").select(*kept, "digest", "proof", "top")
    return alone if frontier is None else frontier.select(*alone.columns).unionByName(alone)


def prove(m: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` plus ``digest`` (the leaf), ``proof`` and ``subroot``.

    ``requests`` has ``grp`` and ``rank`` (as in ``m.leaves``; each pair once) and may have a struct ``row``, which is kept;
    a request for a leaf that does not exist gives no row.
    """
    groups = _descend(m.upper, m.subroots.filter("rank = 0").limit(1).select(
        F.concat("grp", F.lit("")).alias("grp"), F.lit(m.root).alias("digest"), F.lit(len(m.upper)).alias("spans"),
        F.array().cast(PROOF).alias("proof"), F.lit(m.root).alias("top")),
        m.subroots.select("grp", "rank", "name", F.col("spans").alias("below")), m.arity, m.span)
    tops = cut(groups.select(F.col("name").alias("grp"), "digest", F.col("below").alias("spans"), "proof",
                             F.col("digest").alias("top")))
    return _descend(m.store, tops, requests, m.arity, m.span).withColumnRenamed("top", "subroot")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``proof``."""
    return F.aggregate(proof, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
