"""N-gram Jaccard self-join with a token-group matrix; exact for every pair.

A document's set is its distinct word n-grams as 64-bit hashes; two documents
link when ``100 * |intersection| >= percent * |union|``.  Result: one class per
document, the connected components of the links (links inside a class are not
all written out; none between classes is lost).

1. Equal sets collapse to one node (the hash of the sorted set).
2. Similar nodes are partitioned into groups: nodes that share a min-hash are
   compared with one pivot of theirs, the one with the smallest share of tokens
   of its own, and the links found make the first classes; a class is cut into groups of about ``GROUP`` nodes.
3. What can still be missed are links between classes.  In any global order of
   the tokens two linked sets share one of their first ``n - ceil(t n) + 1``
   tokens; the order used puts frequent tokens last, by a counting sketch, which
   decides the cost and not the result.  With ``SHARED - 1`` more tokens they
   share ``SHARED`` of them; a (node, group) pair of different classes that does
   is a candidate.  A first token that no other node has among its own first
   ones is in no set that shares a later one of them, so a node with ``lone``
   such tokens before the shared one overlaps by ``n - lone`` at most: copies
   that each have many tokens of their own meet only nodes that have few.
4. The matrix holds each candidate group's token union.  A node's overlap with
   the union bounds its overlap with every member: a group is opened only if
   the bound reaches what the smallest member needs, and then each member of
   suitable size is compared exactly.

Hot groups: copies are one node; a large class of near copies is linked through
one pivot, so it costs its size, not its square; tables are joined by key with
Spark's skew handling, never gathered per key.  The sketch has a fixed largest
size (``2 ** MAX_SKETCH_BITS`` bytes) whatever the input.

Defined results: a null or empty text, or one without words, has an empty set,
``n_shingles`` 0 and is linked with nothing; fewer words than ``width`` make one
n-gram; a null id has a size but a null class; rows that repeat an id belong to
one document and their sets link it; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bitfilter import filter_of, near, passes, slot_of
from .common import cut, fresh_name, parts, release
from .components import components
from .wordhash import WordHasher, ngrams

WIDTH = 4
PERCENT = 85
GROUP = 64
MIN_HASHES = 4
SHARED = 4
MAX_SKETCH_BITS = 24


def node_of(tokens: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(tokens.tobytes()), ">i8")[0])


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))


def _profiles(texts: DataFrame, width: int, bits: int) -> DataFrame:
    """Per document ``id, node, n, mins``; per task its counts of token slots in ``chunk, blob``.

    A task's counts stop at 255: the sketch only orders tokens.
    """
    seeds = np.random.default_rng(11).integers(1, 2**63, MIN_HASHES, dtype=np.uint64) | np.uint64(1)
    chunks = 1 << max(0, bits - 13)  # small rows: a columnar batch holds thousands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = WordHasher(), np.zeros(1 << bits, np.uint32)
        names = ["id", "node", "n", "mins", "chunk", "blob"]
        for b in parts(batches, 1):
            nodes, sizes, mins = [], [], []
            for words in hasher.texts(b.column(1).to_pylist()):
                t = ngrams(words, width)
                nodes.append(node_of(t))
                sizes.append(len(t))
                mins.append([int(((t * s) ^ (t >> np.uint64(31))).view(np.int64).min()) for s in seeds] if len(t) else [])
                np.add.at(counts, t >> np.uint64(64 - bits), np.uint32(1))
            n = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(mins, pa.list_(pa.int64())),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if counts.any():
            np.minimum(counts, 255, out=counts)
            size, some = len(counts) // chunks, min(chunks, 128)
            for first in range(0, chunks, some):  # a few chunks at a time: no second copy of the sketch
                blobs = [counts[c * size:(c + 1) * size].astype(np.uint8).tobytes() for c in range(first, first + some)]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(some, pa.int64()), pa.nulls(some, pa.int64()), pa.nulls(some, pa.int64()),
                     pa.nulls(some, pa.list_(pa.int64())), pa.array(range(first, first + some), pa.int32()),
                     pa.array(blobs, pa.binary())], names)

    return texts.mapInArrow(run, "id long, node long, n long, mins array<long>, chunk int, blob binary")


def _levels(profiles: DataFrame, bits: int) -> np.ndarray:
    """The sketch's counts, summed over tasks, as a byte of log2 each."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for c, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = np.frombuffer(blob, np.uint8).astype(np.int64)
                sums[c] = sums[c] + got if c in sums else got
        levels = [np.ceil(np.log2(s + 1.0) * 2).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["chunk", "blob"])

    rows = (profiles.filter("chunk is not null").select("chunk", "blob").repartition("chunk")
            .mapInArrow(add, "chunk int, blob binary").collect())
    out = np.zeros(1 << bits, np.uint8)
    for r in rows:
        part = np.frombuffer(r["blob"], np.uint8)
        out[r["chunk"] * len(part):(r["chunk"] + 1) * len(part)] = part
    return out


def prefix_length(n: int, percent: int, shared: int = SHARED) -> int:
    """Two linked sets have ``min(shared, overlap)`` tokens in common among their first so many."""
    return min(n, n - -(-percent * n // 100) + shared)


def _prefixes(texts: DataFrame, width: int, percent: int, levels: np.ndarray, bits: int, nodes: DataFrame,
              at_most: int) -> DataFrame:
    """``node, token, at``: each node's first tokens in the order (level, token), from the document named for it."""
    table, filter_bits = filter_of(nodes.select("node", "id"), at_most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in parts(batches, 1):
            nodes, firsts, places = [], [], []
            for own, words in zip(b.column(0).to_pylist(), hasher.texts(b.column(1).to_pylist())):
                t = ngrams(words, width)
                if own is None or not len(t):
                    continue
                node = np.array([node_of(t)], np.int64)
                if not passes(table, slot_of(filter_bits, node, np.array([own], np.int64)))[0]:
                    continue
                level = levels[t >> np.uint64(64 - bits)]
                # t is sorted, so a stable sort by level breaks ties by token
                part = t[np.argsort(level, kind="stable")[:prefix_length(len(t), percent)]]
                nodes.append(np.full(len(part), node, np.int64))
                firsts.append(part.view(np.int64))
                places.append(np.arange(len(part)))
            if firsts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (nodes, firsts, places)],
                                                 ["node", "token", "at"])

    return texts.mapInArrow(run, "node long, token long, at long")


def _token_sets(texts: DataFrame, width: int, wanted: DataFrame, at_most: int) -> DataFrame:
    """``node, tokens`` of the wanted nodes, each from the document ``id`` that ``wanted`` names for it.

    The texts stay where they are: a bit filter of bounded size goes to them.
    What it lets through by chance is a few more sets, which no join asks for.
    """
    table, bits = filter_of(wanted.select("node", "id"), at_most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in parts(batches, 1):
            ids, sets, nodes = b.column(0).to_pylist(), [], []
            for own, words in zip(ids, hasher.texts(b.column(1).to_pylist())):
                t = ngrams(words, width)
                if own is None or not len(t):
                    continue
                node = node_of(t)
                if passes(table, slot_of(bits, np.array([node], np.int64), np.array([own], np.int64)))[0]:
                    sets.append(t)
                    nodes.append(node)
            ends = np.cumsum([0] + [len(t) for t in sets]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["node", "tokens"])

    return texts.mapInArrow(run, "node long, tokens array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    return both.filter(100 * shared >= percent * (F.size("ta") + F.size("tb") - shared)).select("a", "b")


def _may_link(n1: str, n2: str, percent: int) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _candidates(heads: DataFrame, percent: int) -> DataFrame:
    """``node, n, g_cls, g_part``: the groups of other classes that share enough first tokens with a node.

    ``heads``: ``node, token, most`` (the largest overlap a set that shares the
    token can reach), ``n``, ``cls, part, members``.  Two sides that both fail to
    reach the threshold with a set of their own size cannot reach it together, so
    such rows are joined only with those that can.
    """
    groups = (heads.groupBy("token", "cls", "part").agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max("most").alias("g_most"), F.first("members").alias("g_members"))
        .withColumnsRenamed({"cls": "g_cls", "part": "g_part"}))
    smaller = F.struct("members", "cls") < F.struct(F.col("g_members").alias("members"), F.col("g_cls").alias("cls"))
    fits = ((100 * F.col("n_max") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("n_min"))
            & ((100 + percent) * F.least("most", "g_most") >= percent * (F.col("n") + F.col("n_min"))))
    able, g_able = (100 + percent) * F.col("most") >= 2 * percent * F.col("n"), (100 + percent) * F.col("g_most") >= 2 * percent * F.col("n_min")
    met = [left.join(right, "token").filter(smaller & fits).select("node", "n", "g_cls", "g_part")
           for left, right in ((heads.filter(able), groups), (heads.filter(~able), groups.filter(g_able)))]
    return (met[0].unionByName(met[1]).groupBy("node", "n", "g_cls", "g_part").agg(F.count("*").alias("c"))
            .filter(F.col("c") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100))).drop("c"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
            percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: per row its set size and its class, named by the smallest id."""
    texts = _texts(docs, doc_id, text)
    spark = docs.sparkSession
    n_docs = docs.count()  # bounds the nodes too
    bits = min(MAX_SKETCH_BITS, max(16, math.ceil(math.log2(16 * max(1, n_docs)))))
    profiles = cut(_profiles(texts, width, bits))
    rows = profiles.filter("chunk is null").select("id", "node", "n", "mins")
    nodes = (rows.filter("n > 0 and id is not null").groupBy("node")
             .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("mins").alias("mins")))
    nodes = cut(nodes)

    # tokens that stand among the first of two nodes or more; nodes with too few of them are linked with nothing
    heads = cut(_prefixes(texts, width, percent, _levels(profiles, bits), bits, nodes, n_docs))
    met = cut(heads.groupBy("token").count().filter("count > 1").select("token"))
    heads = cut(near(heads, "token", met).join(met, "token").distinct())
    needed = F.ceil(F.col("n") * percent / 100).cast("long")
    length = F.least("n", F.col("n") - needed + SHARED)
    nodes = cut(nodes.join(heads.groupBy("node").agg(F.count("*").alias("met")), "node")
                .filter(F.col("met") >= F.least(F.lit(SHARED), needed))
                .select("node", "id", "n", "mins", ((length - F.col("met")) / F.col("n")).alias("own")))
    release(spark)

    # nodes that share a min-hash, each with the pivot of its bucket: the one with the least of its own
    keys = nodes.select("node", "n", "own", F.posexplode("mins").alias("slot", "key"))
    pivots = (keys.groupBy("slot", "key").agg(F.min(F.struct("own", "node", "n")).alias("p"), F.count("*").alias("c"))
              .filter("c > 1").select("slot", "key", F.col("p.node").alias("b"), F.col("p.n").alias("nb")))
    stars = cut(keys.join(pivots, ["slot", "key"]).filter((F.col("node") != F.col("b")) & _may_link("n", "nb", percent))
                .select(F.col("node").alias("a"), "b").distinct())
    ends = stars.select(F.col("a").alias("node")).union(stars.select(F.col("b").alias("node"))).distinct()
    starred = cut(nodes.join(ends, "node").select("node", "id"))
    sets = cut(_token_sets(texts, width, starred, n_docs))
    links = cut(_linked(stars, sets, percent))
    release(spark)
    first = components(links)

    classed = nodes.select("node", "id", "n").join(first, "node", "left").withColumn("cls", F.coalesce("label", "node"))
    members = classed.groupBy("cls").agg(F.count("*").alias("members"))
    grouped = cut(classed.join(members, "cls").select(
        "node", "id", "n", "cls", "members",
        F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / GROUP).cast("long")).alias("part")))
    before = F.row_number().over(Window.partitionBy("node").orderBy("at")) - 1
    heads = heads.withColumn("lone", F.col("at") - before).join(grouped.drop("id"), "node")
    asked = cut(_candidates(cut(heads.withColumn("most", F.col("n") - F.col("lone")).drop("at", "lone")), percent))

    opened = grouped.select(F.col("node").alias("b"), F.col("id").alias("b_id"), F.col("n").alias("nb"),
                            F.col("cls").alias("g_cls"), F.col("part").alias("g_part"), "members")
    opened = cut(opened.join(asked.select("g_cls", "g_part").distinct(), ["g_cls", "g_part"], "left_semi"))
    wanted = (grouped.join(asked.select("node").distinct(), "node", "left_semi").select("node", "id")
              .union(opened.select("b", "b_id")).distinct().join(starred.select("node"), "node", "left_anti"))
    sets = sets.unionByName(cut(_token_sets(texts, width, cut(wanted), n_docs)))
    # the matrix: token unions of the groups asked for (a group of one is its own union: compared at once)
    many = opened.filter("members > 1")
    asked_many = cut(asked.join(many.select("g_cls", "g_part").distinct(), ["g_cls", "g_part"], "left_semi"))
    matrix = (many.join(near(sets, "node", many.select("b"), at_most=n_docs).withColumnRenamed("node", "b"), "b").groupBy("g_cls", "g_part")
              .agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"), F.min("nb").alias("least")))
    bound = F.size(F.array_intersect("tokens", "union"))
    qualified = (asked_many.join(near(sets, "node", asked_many.select("node"), at_most=n_docs), "node").join(matrix, ["g_cls", "g_part"])
                 .filter(100 * bound >= percent * F.greatest("n", "least")).select("node", "n", "g_cls", "g_part"))
    alone = asked.join(opened.filter("members = 1").select("g_cls", "g_part"), ["g_cls", "g_part"], "left_semi")
    pairs = cut(qualified.unionByName(alone.select("node", "n", "g_cls", "g_part")).join(opened, ["g_cls", "g_part"])
                .filter(_may_link("n", "nb", percent)).select(F.col("node").alias("a"), "b").distinct())
    paired = pairs.select("a").union(pairs.select("b")).distinct()
    links = _linked(pairs, near(sets, "node", paired, at_most=n_docs), percent)
    # the first classes are the nodes of what is left: only links between them are followed
    class_of = grouped.select("node", "cls")
    between = (links.join(class_of.withColumnsRenamed({"node": "a", "cls": "u"}), "a")
               .join(class_of.withColumnsRenamed({"node": "b", "cls": "v"}), "b"))
    second = components(between, "u", "v").withColumnRenamed("node", "cls")
    release(spark)

    named = rows.filter("n > 0 and id is not null").select("id", "node").distinct()
    # ids are nodes of the graph too: an id with several sets ties them together
    labelled = cut(named.join(class_of, "node", "left").join(second, "cls", "left")
                   .select("id", "node", F.coalesce("label", "cls", "node").alias("label")))
    repeated = labelled.groupBy("id").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
    if repeated.limit(1).count():
        ties = labelled.join(repeated.select("id", "a"), "id").select("a", F.col("label").alias("b"))
        merged = components(ties.filter("a <> b"))
        labelled = (labelled.join(merged.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
                    .select("id", "node", F.coalesce("top", "label").alias("label")))
    least = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    of_id = labelled.select("id", "label").distinct().join(least, "label").select(F.col("id").alias("own"), "component_id")
    return (rows.join(of_id, F.col("id") == F.col("own"), "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                         percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each class: one with the smallest id (null ids last).

    Rows with equal id and text are one document of the graph, all others are documents
    of their own, also those without an id.  Rows without words stay.
    """
    key = fresh_name(docs, "__key")
    keyed = docs.withColumn(key, F.xxhash64(docs[doc_id].cast("long"), F.lit("|"), docs[text].cast("string")))
    found = (classes(keyed.select(key, text), key, text, width, percent).filter("n_shingles > 0")
             .groupBy(F.col("doc_id").alias("k")).agg(F.first("component_id").alias("cls"), F.count("*").alias("times")))
    ids = keyed.select(F.col(key).alias("k"), keyed[doc_id].cast("long").alias("id")).groupBy("k").agg(F.min("id").alias("id"))
    members = cut(found.join(ids, "k"))
    best = (members.groupBy("cls").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("best"))
            .select(F.col("best.k").alias("k")))
    lost = members.join(best, "k", "left_anti").select("k")
    repeated = members.filter("times > 1").join(best, "k", "left_semi").select("k")
    out = cut(lost.withColumn("again", F.lit(False)).unionByName(repeated.withColumn("again", F.lit(True))))
    gone, again = out.select(F.col("k").alias(key)), out.filter("again").select(F.col("k").alias(key))
    once = keyed.join(gone, key, "left_anti")
    one = keyed.join(again, key, "left_semi").dropDuplicates([key])
    return once.select(*keyed.columns).unionByName(one.select(*keyed.columns)).drop(key)
