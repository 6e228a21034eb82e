"""Target-distribution importance resampling: hashed n-gram features, array-scored weights, distributed quickselect.

Features of a text are its runs of 1 to ``ORDERS`` words, hashed by CRC-32 into
``buckets``.  A bucket's gain is the scaled log ratio of its smoothed shares in
the target and in the corpus; a text's weight is the sum of the gains of its
features, and a Gumbel number drawn from its id makes the highest scores a
sample without replacement in proportion to the weights.

* **Counting and scoring** are two passes over the texts with numpy inside
  tasks.  A task adds its counts up before they are shuffled (one row per bucket
  that occurs); the gains are one array of ``buckets`` numbers, which every task
  gets.  CRC-32 is linear, so the hash of a run of words follows from the hashes
  of its words by table look-ups, and no string of a run is ever built.
* **Selection**: all keys ``(-score, doc_id, row)`` are unique.  Each round draws
  random pivot keys from the range that still holds the k-th key, counts exactly
  how many keys lie below each pivot (at the pivot there is one), and narrows
  the range.  Only pivots and counts reach the driver.  The winners alone are
  sorted and ranked, by :func:`ranking.ranked`.

Long texts are read in windows of whole words with two words of context, so
memory follows the window and the longest word.

Defined results: null and empty texts have no words, no features and weight 0;
texts with fewer than ``MIN_WORDS`` words are scored but never drawn; repeated
rows are judged one by one (equal keys are told apart by their row); a row
without an id is hashed as the id ``null`` and comes after all ids in a tie; an
empty corpus gives no rows, an empty target a target of equal shares; other
columns are kept whatever their names.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patrolstat.operators.ranking import ranked

from .common import cut, fresh_name, parts

BUCKETS = 10_000
ORDERS = 3
MIN_WORDS = 20
WINDOW = 1 << 21
PIVOTS = 31
_NEAR = 64  # words up to this length are hashed in parallel, shifts up to it have a table of their own
_ONES = np.uint32(0xFFFFFFFF)


def _is_word() -> np.ndarray:
    """Bytes of words: digits, letters and every byte of a character beyond ASCII."""
    table = np.zeros(256, bool)
    for a, b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[a:b + 1] = True
    return table


def _step_table() -> np.ndarray:
    """The CRC-32 register's change by one byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t.astype(np.uint32)


class RunHasher:
    """Buckets of all runs of 1 to 3 words of texts, given as UTF-8 bytes."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = np.uint32(buckets)
        self.word_byte = _is_word()
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[0x41:0x5B] += 0x20
        self.step = _step_table()
        # near[k][n * 256 + v]: the register (v << 8k) after n zero bytes
        layer = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        near = []
        for _ in range(_NEAR):
            near.append(layer)
            layer = self.step[layer & np.uint32(255)] ^ (layer >> np.uint32(8))
        self.near = np.ascontiguousarray(np.stack(near, 1).reshape(4, -1))
        self.far = [layer]  # far[j][k][v]: after 64 * 2**j zero bytes
        while len(self.far) < 25:
            last = self.far[-1]
            self.far.append(np.stack([self._through(last, last[k]) for k in range(4)]))

    @staticmethod
    def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (table[0][x & np.uint32(255)] ^ table[1][(x >> np.uint32(8)) & np.uint32(255)]
                ^ table[2][(x >> np.uint32(16)) & np.uint32(255)] ^ table[3][x >> np.uint32(24)])

    def shift(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Registers ``x`` after ``n`` zero bytes each."""
        at = (n & (_NEAR - 1)) << 8
        out = (self.near[0][at + (x & np.uint32(255))] ^ self.near[1][at + ((x >> np.uint32(8)) & np.uint32(255))]
               ^ self.near[2][at + ((x >> np.uint32(16)) & np.uint32(255))] ^ self.near[3][at + (x >> np.uint32(24))])
        high = n >> 6
        if high.any():
            for j in range(int(high.max()).bit_length()):
                rows = np.flatnonzero((high >> j) & 1)
                out[rows] = self._through(self.far[j], out[rows])
        return out

    def words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Registers of the words, each begun at 0."""
        out = np.zeros(len(starts), np.uint32)
        live = np.flatnonzero(lengths <= _NEAR)
        at, left, register = starts[live], lengths[live], np.zeros(len(live), np.uint32)
        k = 0
        while len(live):
            register = self.step[(register ^ data[at + k]) & np.uint32(255)] ^ (register >> np.uint32(8))
            k += 1
            on = left > k
            if not on.all():
                out[live[~on]] = register[~on]
                live, at, left, register = live[on], at[on], left[on], register[on]
        for i in np.flatnonzero(lengths > _NEAR):
            word = data[starts[i]:starts[i] + lengths[i]].tobytes()
            out[i] = zlib.crc32(word, 0xFFFFFFFF) ^ 0xFFFFFFFF
        return out

    def runs(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """For each word the buckets of the runs of 1, 2 and 3 words that end at it.

        The first run of 2 and the first two of 3 have no meaning; neither have those across texts.
        """
        register = self.words(data, starts, lengths)
        run, size, out = register, lengths, []
        spaced = self.shift(np.broadcast_to(self.step[0x20], register.shape).copy(), lengths) ^ register  # of " word"
        for order in range(ORDERS):
            crc = self.shift(np.full(len(run), _ONES), size) ^ run ^ _ONES
            out.append((crc % self.buckets).astype(np.int32))
            if order < ORDERS - 1:
                # the run that ends one word earlier, then " word"
                run = self.shift(np.concatenate((run[:1], run[:-1])), lengths + 1) ^ spaced
                size = np.concatenate((size[:1], size[:-1])) + lengths + 1
        return out

    def windows(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Runs of whole texts of ``column`` (string): ``(text of each word, its place there, runs)``.

        Texts are taken together up to ``WINDOW`` bytes; a longer text comes in several windows,
        each after the first with the last ``ORDERS - 1`` words of the one before as context.
        A word's place counts from the context; runs longer than place + 1 do not belong to the text,
        and places below a window's context (given as -1) have been counted already.
        """
        column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        text, n = 0, len(column)
        while text < n:
            last = text + 1
            while last < n and offsets[last + 1] - offsets[text] <= WINDOW:
                last += 1
            if offsets[last] - offsets[text] <= WINDOW:
                yield self._window(data, offsets[text:last + 1], text, 0)[0]
            else:
                at, reach, context = int(offsets[text]), int(offsets[text]), 0
                end = int(offsets[text + 1])
                while reach < end:
                    reach = min(end, reach + WINDOW)
                    while reach < end and self.word_byte[data[reach]]:  # to the end of the word
                        reach = min(end, reach + max(1, int(np.argmin(np.append(self.word_byte[data[reach:reach + 4096]], False)))))
                    found, starts = self._window(data, np.array([at, reach]), text, context)
                    yield found
                    keep = starts[-(ORDERS - 1):]
                    at, context = (int(keep[0]), len(keep)) if len(keep) else (reach, 0)
                last = text + 1
            text = last

    def _window(self, data, offsets, first_text, context):
        base, end = int(offsets[0]), int(offsets[-1])
        part = self.lower[data[base:end]]
        inside = self.word_byte[part]
        bounds = offsets - base
        heads = np.zeros(len(part) + 1, bool)
        heads[bounds] = True
        before = np.concatenate(([False], inside[:-1])) & ~heads[:-1]
        after = np.concatenate((inside[1:], [False])) & ~heads[1:]
        starts = np.flatnonzero(inside & ~before)
        lengths = np.flatnonzero(inside & ~after) + 1 - starts
        firsts = np.searchsorted(starts, bounds)
        per_text = np.diff(firsts)
        of_text = np.repeat(np.arange(len(per_text)), per_text)
        place = np.arange(len(starts)) - firsts[:-1][of_text]
        place[:context] = -1
        runs = self.runs(part, starts, lengths) if len(starts) else [np.empty(0, np.int32)] * ORDERS
        if context:
            place[context:] = np.arange(context, len(starts))
        return (of_text + first_text, place, runs), starts + base


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how often each bucket's features occur in all texts (buckets that occur)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = RunHasher(buckets), np.zeros(buckets, np.int64)
        for part in parts(batches, 0):
            for _, place, runs in hasher.windows(part.column(0)):
                for order, run in enumerate(runs):
                    total += np.bincount(run[place >= order], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    per_task = texts.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "bucket long, n long")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain: ``floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))`` (``buckets`` numbers)."""
    def counted(df: DataFrame) -> list[int]:
        found = {r.bucket: r.n for r in bucket_counts(df, text, buckets).collect()}  # at most ``buckets`` rows
        return [found.get(b, 0) for b in range(buckets)]

    s, t = counted(corpus), counted(target)
    many, few = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((y + 1) * many / ((x + 1) * few))) for x, y in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", n_words: str = "n_words", n_features: str = "n_features",
          weight: str = "weight") -> DataFrame:
    """``docs`` plus its words, features and weight (long)."""
    buckets, at = len(gain), docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in (n_words, n_features, weight))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RunHasher(buckets)
        for part in parts(batches, at):
            n, feats, sums = (np.zeros(part.num_rows, np.int64) for _ in range(3))
            for of_text, place, runs in hasher.windows(part.column(at)):
                fresh = place >= 0
                n += np.bincount(of_text[fresh], minlength=len(n))
                worth = np.zeros(len(place), np.int64)
                for order, run in enumerate(runs):
                    ok = place >= order
                    worth += np.where(ok, gain[run], 0)
                    feats += np.bincount(of_text[ok], minlength=len(n))
                if len(of_text):
                    ends = np.concatenate((np.flatnonzero(np.diff(of_text)), [len(of_text) - 1]))
                    upto = np.cumsum(worth)[ends]
                    sums[of_text[ends]] += np.diff(upto, prepend=0)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(x, pa.int64()) for x in (n, feats, sums))],
                [*part.schema.names, n_words, n_features, weight])

    return docs.mapInArrow(add, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """``floor(-1000 ln(-ln(u)))`` with ``u`` from the first 8 hex digits of sha256(``seed:doc_id``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def smallest(keyed: DataFrame, key: str, k: int, pivots: int = PIVOTS, seed: int = 0):
    """The k-th smallest (from 1) of the unique, non-null struct column ``key``: a Row, or None where there are fewer.

    Distributed quickselect with several pivots a round; rounds grow with the logarithm of the rows.
    ``keyed`` is read once for pivots and once for counts in each round, so it should be a written table.
    """
    if k < 1:
        return None
    names = keyed.schema[key].dataType.fields

    def literal(row) -> Column:
        return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in names])

    low = high = None  # the k-th key lies after low and before high
    below = 0          # keys up to low
    for turn in range(1 << 20):
        inside = keyed.select(key)
        if low is not None:
            inside = inside.filter(F.col(key) > literal(low))
        if high is not None:
            inside = inside.filter(F.col(key) < literal(high))
        drawn = sorted(tuple(r[0]) for r in inside.orderBy(F.xxhash64(F.col(key), F.lit(seed), F.lit(turn)), key).limit(pivots).collect())
        if not drawn:
            return None
        rows = [dict(zip([f.name for f in names], d)) for d in drawn]
        counts = inside.agg(*[F.count_if(F.col(key) < literal(r)).alias(f"c{i}") for i, r in enumerate(rows)], F.count("*").alias("n")).first()
        if below + counts["n"] < k:
            return None
        ranks = [below + counts[f"c{i}"] + 1 for i in range(len(rows))]
        i = bisect.bisect_left(ranks, k)
        if i < len(ranks) and ranks[i] == k:
            return rows[i]
        high = rows[i] if i < len(rows) else high
        if i:
            low, below = rows[i - 1], ranks[i - 1]
    raise AssertionError("unique keys are always found")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, doc_id: str = "doc_id", text: str = "text",
             min_words: int = MIN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """All of ``docs`` without ``text``, plus ``n_features``, ``weight``, ``score`` and ``rank`` (from 1; null: not drawn).

    Drawn are the floor(``percent`` * N / 100) highest scores of the N texts of ``min_words`` words or more.
    """
    gain = gains(docs, target, text, buckets)
    names = [fresh_name(docs, c) for c in ("n_words", "n_features", "weight", "score", "rank", "sort_key")]
    n_words, n_features, weight, score, rank, key = names
    body = fresh_name(docs, "text_")
    plain = docs.withColumn(body, F.col(text).cast("string")).drop(text)
    found = weigh(plain, gain, body, n_words, n_features, weight).drop(body)
    found = found.withColumn(score, F.col(weight) + gumbel(F.col(doc_id), seed))
    found = cut(found.withColumn(key, F.when(F.col(n_words) >= min_words, F.struct(
        (-F.col(score)).alias("s"), F.col(doc_id).isNull().alias("no_id"), F.coalesce(F.col(doc_id), F.lit(0)).alias("id"),
        F.monotonically_increasing_id().alias("row")))))
    k = percent * found.filter(F.col(key).isNotNull()).count() // 100
    last = smallest(found.filter(F.col(key).isNotNull()), key, k)
    if last is None:
        return found.withColumn(rank, F.lit(None).cast("long")).drop(key)
    types = {f.name: f.dataType for f in found.schema[key].dataType.fields}
    drawn = F.coalesce(F.col(key) <= F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in last.items()]), F.lit(False))
    winners = ranked(found.filter(drawn), [F.col(key)], rank=rank).withColumn(rank, F.col(rank) + 1)
    return winners.unionByName(found.filter(~drawn).withColumn(rank, F.lit(None).cast("long"))).drop(key)
