"""Exact removal of repeated byte strings by sparse suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else
too, in the same document or another.  Matches never cross documents.

1. Anchors.  In every window of ``LENGTH`` bytes the ``GRAM``-byte gram with the
   smallest hash (the last one, among equals) is an anchor.  It depends on the
   window's bytes alone, so equal windows have equal anchors at equal places:
   suffixes need comparing only where they start at anchors of equal hash.
2. An anchor's context is all windows that hold it: up to ``LENGTH - GRAM``
   bytes before and ``LENGTH`` from it on.  An anchor hash met once is dropped;
   one met again with the same context makes the whole context repeated.
3. Anchors met in different contexts are sorted: the suffixes from the anchor
   on, and the reversed prefixes before it, by deep-shallow sorting (multikey
   quicksort, then blind tries), once per distinct context.  Two windows at
   distance ``s`` before the anchor are equal if the suffixes agree in
   ``LENGTH - s`` bytes and the prefixes in ``s``: classes of the two sorted
   orders, cut at those depths.  All windows of an anchor overlap, so the first
   and the last repeated one bound what goes.
4. The intervals meet the texts in one join, and the rest is put together.

Hot anchors: equal contexts are one row before any shuffle.  A group of more than
``HOT`` different contexts is split by the next bytes: windows that start ``low``
to ``high`` bytes before the anchor can be equal only where the last ``low`` bytes
before it and the first ``LENGTH - high`` from it on are, so each half of the
distances gets groups of its own by those bytes.  Contexts that agree in all
bytes these distances can reach are repeated there as a whole and go on as one
row, so what is split again are different contexts only, until a group is small.

Defined results: a null text is empty; documents shorter than ``LENGTH`` keep
everything; repeated rows are documents that repeat each other; null ids are
ids; an empty table gives no rows; other columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bitfilter import filter_of, near, passes, slot_of
from .common import cut, discard, fresh_name, parts, release
from .deep_shallow import deep_shallow_sort
from .wordhash import mixed

LENGTH = 200
GRAM = 32
BATCH = 20_000
HOT = BATCH
_PIECE = 1 << 20
_P = 0x9E3779B97F4A7C15


class _Grams:
    """Hashes of all grams of a buffer by prefix sums; holds the tables of powers."""

    def __init__(self, gram: int, n: int):
        self.gram = gram
        self.value = np.random.default_rng(3).integers(1, 2**64, 256, dtype=np.uint64)
        inverse = pow(_P, -1, 1 << 64)
        self.powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, _P, np.uint64))))
        self.inverses = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, inverse, np.uint64))))

    def of(self, a: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(self.value[a] * self.powers[: len(a)], out=sums[1:])
        n = len(a) - self.gram + 1
        return mixed((sums[self.gram:] - sums[:n]) * self.inverses[:n])


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours (block prefix and suffix minima)."""
    n = len(x)
    pad = -n % w
    full = np.concatenate((x, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1: n])


class Anchors:
    """The anchors of documents of at least ``length`` bytes."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.grams = _Grams(gram, _PIECE + 2 * length)

    def _piece(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        h = self.grams.of(np.frombuffer(data, np.uint8))
        low = np.uint64((1 << 22) - 1)
        # smallest hash first, and among equal hashes the largest place
        best = _window_min((h & ~low) | (low - np.arange(len(h), dtype=np.uint64)), self.length - self.gram + 1)
        best = best[np.concatenate(([True], best[1:] != best[:-1]))]
        at = np.unique((low - (best & low)).astype(np.int64))
        return at, h[at]

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors, places rising."""
        if len(data) < self.length:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        places, hashes, at = [], [], 0
        while at == 0 or at + self.length <= len(data):
            p, h = self._piece(data[at: at + _PIECE + self.length - 1])
            places.append(p + at)
            hashes.append(h)
            at += _PIECE
        if len(places) == 1:
            return places[0], hashes[0]
        p, first = np.unique(np.concatenate(places), return_index=True)
        return p, np.concatenate(hashes)[first]

    def context(self, data: bytes, at: int) -> tuple[bytes, bytes]:
        """The bytes before the anchor and from it on that windows holding it can reach."""
        return data[max(0, at - self.length + self.gram): at], data[at: at + self.length]


def _context_hash(before: bytes, after: bytes) -> int:
    h = xxhash.xxh3_64()
    h.update(before)
    return xxhash.xxh3_64_intdigest(after, h.intdigest() ^ len(before)) - (1 << 63)


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``rid, at, key, ctx`` of all anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        for b in parts(batches, 1):
            rid, at, key, ctx = [], [], [], []
            for r, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                places, hashes = anchors.of(data)
                if len(places):
                    rid.append(np.full(len(places), r, np.int64))
                    at.append(places)
                    key.append(hashes.view(np.int64))
                    ctx += [_context_hash(*anchors.context(data, p)) for p in places.tolist()]
            if rid:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rid)), pa.array(np.concatenate(at)),
                                                  pa.array(np.concatenate(key)), pa.array(ctx, pa.int64())],
                                                 ["rid", "at", "key", "ctx"])

    return texts.mapInArrow(run, "rid long, at long, key long, ctx long")


def _contexts(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """``key, ctx, before, after`` of the wanted anchors (``rid, at``): read where the texts are,
    through a bit filter of bounded size; what passes by chance is joined away."""
    table, bits = filter_of(wanted.select("rid", "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        for b in parts(batches, 1):
            rows = []
            for r, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                places, hashes = anchors.of(data)
                if len(places):
                    ok = passes(table, slot_of(bits, np.full(len(places), r, np.int64), places))
                    for p, h in zip(places[ok].tolist(), hashes[ok].view(np.int64).tolist()):
                        before, after = anchors.context(data, p)
                        rows.append((r, p, h, _context_hash(before, after), before, after))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.binary()] * 2)],
                ["rid", "at", "key", "ctx", "before", "after"])

    found = texts.mapInArrow(run, "rid long, at long, key long, ctx long, before binary, after binary")
    return found.join(wanted.select("rid", "at", "n"), ["rid", "at"]).dropDuplicates(["key", "ctx"]).drop("rid", "at")


def repeated_windows(groups: np.ndarray, before: list[bytes], after: list[bytes], length: int,
                     low: list[int], high: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For contexts sorted by group: the smallest and largest distance of a window's start before its
    anchor, from ``low`` to ``high``, for which another context of the group has an equal window (-1: none)."""
    n = len(groups)
    bounds = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1], [True])))
    back = [x[::-1] for x in before]
    ranks = np.zeros((2, n), np.int64)
    lcps = np.full((2, n), -1, np.int64)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        # groups are hashes: what the members must share is looked at before sorting starts behind it
        shared: dict[tuple[bytes, bytes], list[int]] = {}
        for i in range(lo, hi):
            shared.setdefault((back[i][: low[i]], after[i][: length - high[i]]), []).append(i)
        at = lo
        for (head_back, head_after), members in shared.items():
            for side, strings, head in ((0, after, head_after), (1, back, head_back)):
                order, lcp = deep_shallow_sort(strings, start=len(head), group=members)
                ranks[side, at: at + len(members)] = order
                lcps[side, at: at + len(members)] = lcp
            at += len(members)
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    by_after, by_before = np.empty(n, np.int64), np.empty(n, np.int64)
    least, most = np.array(low, np.int64), np.array(high, np.int64)
    for s in range(min(low, default=0), max(high, default=-1) + 1):
        by_after[ranks[0]] = np.cumsum(lcps[0] < length - s)
        by_before[ranks[1]] = np.cumsum(lcps[1] < s)
        window = by_after * (n + 1) + by_before
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twin = np.zeros(n, bool)
        twin[order[1:][same]] = True
        twin[order[:-1][same]] = True
        twin &= (least <= s) & (s <= most)
        first[twin & (first < 0)] = s
        last[twin] = s
    return first, last


def _grouped(contexts: DataFrame, length: int) -> DataFrame:
    """``contexts`` (with ``low, high``) plus ``part``: equal for contexts that may share a window at those distances."""
    return contexts.withColumn("part", F.expr(
        f"xxhash64(key, low, substring(before, length(before) - low + 1, low), substring(after, 1, {length} - high))"))


def _sorted_intervals(grouped: DataFrame, length: int, gram: int) -> DataFrame:
    """``key, ctx, lo, hi`` (relative to the anchor) of contexts, groups gathered in one place each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            group, keys, ctx, n, low, high, before, after = zip(*rows)
            first, last = repeated_windows(np.array(group, np.int64), list(before), list(after), length, list(low), list(high))
            full = np.array(n, np.int64) > 1
            lo = np.where(full, gram - length, -last)
            hi = np.where(full, length, length - first)
            keep = full | (first >= 0)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, np.int64)[keep]), pa.array(np.array(ctx, np.int64)[keep]),
                 pa.array(lo[keep]), pa.array(hi[keep])], ["key", "ctx", "lo", "hi"])

        held: list[tuple] = []
        for b in batches:
            held += zip(*[c.to_pylist() for c in b.columns])
            if len(held) >= BATCH:
                end = len(held)
                while end and held[end - 1][0] == held[-1][0]:  # the last group may go on
                    end -= 1
                if end:
                    yield done(held[:end])
                    held = held[end:]
        if held:
            yield done(held)

    return (grouped.select("part", "key", "ctx", "n", "low", "high", "before", "after").repartition("part")
            .sortWithinPartitions("part").mapInArrow(run, "key long, ctx long, lo long, hi long"))


def _halves(grouped: DataFrame, length: int) -> DataFrame:
    """Each context once for either half of its distances, if it has windows there, in the groups of that half;
    ``whole`` is equal for contexts with the same windows at all of these distances."""
    halves = grouped.withColumn("half", F.explode(F.expr(
        "array(struct(low as low, int(div(low + high, 2)) as high), struct(int(div(low + high, 2) + 1) as low, high as high))")))
    halves = halves.select("key", "ctx", "n", "half.low", "half.high", "before", "after")
    halves = _grouped(halves.filter(f"low <= high and length(before) >= low and length(after) >= {length} - high"), length)
    reach = "least(high, length(before))"
    return halves.withColumn("whole", F.expr(
        f"xxhash64(key, low, high, {reach}, substring(before, length(before) - {reach} + 1, {reach}), "
        f"substring(after, 1, {length} - low))"))


def context_intervals(contexts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``key, ctx, lo, hi``: the bytes round an anchor that windows equal to another context's cover.

    Groups of more than ``hot`` contexts are split until they are smaller; that takes as many rounds as
    halving ``length - gram`` distances, and only the contexts of such groups go on.
    """
    spark = contexts.sparkSession
    todo = cut(_grouped(contexts.select("key", "ctx", "n", F.lit(0).alias("low"), F.lit(length - gram).alias("high"),
                                        "before", "after"), length))
    found: DataFrame | None = None
    for more in range(length.bit_length(), -1, -1):
        large = cut(todo.groupBy("part").count().filter(F.col("count") > max(hot, 1)).select("part"))
        split_on = more > 0 and bool(large.limit(1).count())
        now = cut(_sorted_intervals(todo.join(large, "part", "left_anti") if split_on else todo, length, gram))
        found = now if found is None else found.unionByName(now)
        if not split_on:
            break
        split = cut(_halves(todo.join(large, "part", "left_semi"), length))
        classes = cut(split.groupBy("part", "whole").agg(
            F.min_by(F.struct("key", "ctx", "n", "low", "high", "before", "after"), "ctx").alias("one"), F.count("*").alias("members")))
        alike = split.join(classes.filter("members > 1").select("part", "whole"), ["part", "whole"], "left_semi")
        found = found.unionByName(cut(alike.select(
            "key", "ctx", F.expr(f"if(n > 1, {gram - length}, -least(high, length(before)))").cast("long").alias("lo"),
            F.expr(f"if(n > 1, {length}, {length} - greatest(low, {length} - length(after)))").cast("long").alias("hi"))))
        discard(todo, large, split)
        release(spark)
        todo = classes.select("part", "one.*")
    discard(todo, large)
    release(spark)
    return found.groupBy("key", "ctx").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def intervals(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``rid, at, lo, hi``: per repeated anchor the bytes ``[at + lo, at + hi)`` that go (ends may pass the text's)."""
    spark = texts.sparkSession
    anchors = cut(_anchor_rows(texts, length, gram))
    keys = cut(anchors.groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("c1"), F.max("ctx").alias("c2"))
               .filter("n > 1").select("key", (F.col("c1") != F.col("c2")).alias("several")))
    met = cut(near(anchors, "key", keys.select("key")).join(keys, "key"))
    discard(anchors, keys)
    release(spark)
    wanted = cut(met.filter("several").groupBy("key", "ctx")
                 .agg(F.min(F.struct("rid", "at")).alias("one"), F.count("*").alias("n"))
                 .select("key", "ctx", "n", "one.rid", "one.at"))
    found = cut(context_intervals(_contexts(texts, wanted, length, gram), length, gram, hot))
    discard(wanted)
    release(spark)
    whole = met.filter("not several").select("rid", "at", F.lit(gram - length).cast("long").alias("lo"),
                                             F.lit(length).cast("long").alias("hi"))
    return whole.unionByName(met.filter("several").join(found, ["key", "ctx"]).select("rid", "at", "lo", "hi"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   hot: int = HOT, kept: str = "kept", spans: str = "removed", size: str = "n_bytes") -> DataFrame:
    """``docs`` plus ``n_bytes``, ``removed`` (maximal runs as ``array<struct<start,end>>``, bytes) and
    ``kept`` (the remaining bytes)."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    col = dict(zip([c.lower() for c in docs.columns], names))
    data = F.coalesce(F.col(col[text.lower()]).cast("string"), F.lit("")).cast("binary")
    plain = docs.toDF(*names)
    plain = plain.withColumn("rid", F.xxhash64(F.col(col[doc_id.lower()]), F.col(col[text.lower()]))).withColumn("data", data)
    found = intervals(plain.select("rid", "data"), length, gram, hot)
    # equal rows share their intervals, each of them listed once
    per_doc = found.distinct().groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("at", "lo", "hi"))).alias("cuts"))
    joined = plain.join(per_doc.withColumnRenamed("rid", "r"), F.col("rid") == F.col("r"), "left")
    joined = joined.select(*names, "data", "cuts")
    extra = [T.StructField("n_bytes", T.LongType()),
             T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                                T.StructField("end", T.LongType())]))),
             T.StructField("kept", T.BinaryType())]
    schema = T.StructType([*plain.select(*names).schema.fields, *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, len(names)):
            sizes, gone, rest = [], [], []
            for x, cuts in zip(b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist()):
                runs: list[list[int]] = []
                for c in sorted((max(0, c["at"] + c["lo"]), min(len(x), c["at"] + c["hi"])) for c in cuts or ()):
                    if runs and c[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], c[1])
                    else:
                        runs.append(list(c))
                ends = [0, *(e for r in runs for e in r), len(x)]
                sizes.append(len(x))
                gone.append([{"start": s, "end": e} for s, e in runs])
                rest.append(b"".join(x[s:e] for s, e in zip(ends[::2], ends[1::2])))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(names)], pa.array(sizes, pa.int64()),
                 pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(rest, pa.binary())],
                [*names, "n_bytes", "removed", "kept"])

    out = joined.mapInArrow(run, schema)
    return out.toDF(*docs.columns, fresh_name(docs, size), fresh_name(docs, spans), fresh_name(docs, kept))
