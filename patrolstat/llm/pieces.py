"""SentencePiece encoding with N-best segmentation, and decoding.

The vocabulary comes from a model file (a parameter; read on the driver, sent
with the job).  A text is cut into pieces of the vocabulary so that the sum of
piece scores is largest.  A piece's score is its log probability under Zipf's
law at its rank in the vocabulary, in whole millionths, so that sums are exact
and ties are real ties; byte pieces rank last.

Over the lattice of pieces, forward Viterbi gives the best score up to every
place.  The N best segmentations come from a backward A-star search that starts
at the end and uses these scores as its heuristic: they are exact, so complete
segmentations leave the heap in order of score (ties: by the ids read from the
end).  No piece holds a space mark after another character, so the lattice falls
apart into chunks at such places; chunks are searched once and cached, and the N
best of a text are combined from the chunks whose second best costs least.

A space is the mark U+2581, one is put before the text; a literal mark and
characters without a piece become byte pieces, so decoding restores every text.

Defined results: a null text gives null ids, an empty one no ids; repeated rows
are encoded one by one; an empty table gives no rows; other columns are kept
whatever their names.  Unknown ids decode to nothing.
"""

from __future__ import annotations

import gc
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import fresh_name, parts
from .wordhash import mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3
MARK, LITERAL = "▁", "\ud800"  # a lone surrogate cannot occur in a text
CACHE = 300_000
ZIPF_SHIFT = 2.7
PREPARE = 1 << 20       # characters whose chunks are searched at once
ABREAST = 4_096         # chunks of a length searched at once
TOGETHER = 18           # chunks up to this length are searched side by side
_MOST_IDS = (1 << 18) - 1
_CODE = 23              # bits of a packed piece below its score: 18 of its id, 5 of its length
_NONE = -(1 << 35)
_FAR = 1 << 60          # the loss where there is no second best
_LOWEST = -(1 << 60)
_P = 0x9E3779B97F4A7C15


@dataclass
class Vocabulary:
    """``score``: piece -> (score in millionths, id); ``raw``: id -> bytes; ``byte_ids``: byte -> id."""
    score: dict[str, tuple[int, int]]
    raw: dict[int, bytes]
    byte_ids: list[int]
    byte_score: int
    longest: int
    chunk: str


def load(model: str = MODEL) -> Vocabulary:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model)
    n = m.get_piece_size()
    norm = math.log(math.log(n))
    rank, score, raw, byte_ids = 0, {}, {}, [0] * 256
    for i in range(n):
        piece = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            raw[i] = bytes([int(piece[3:-1], 16)])
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            score[piece] = (round(-1e6 * (math.log(rank + ZIPF_SHIFT) + norm)), i)
            raw[i] = piece.replace(MARK, " ").encode("utf-8")
            rank += 1
    crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in score)
    alone = "".join(c for c in "\n\t\r" if not any(c in p for p in score))
    chunk = (r"(?s).+" if crossing else
             rf"[{alone}]|{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" if alone else rf"{MARK}+[^{MARK}]*|[^{MARK}]+")
    return Vocabulary(score, raw, byte_ids, round(-1e6 * (math.log(n + ZIPF_SHIFT) + norm)), max(map(len, score)), chunk)


class Lattice:
    """The pieces of one chunk, by where they end."""

    def __init__(self, text: str, v: Vocabulary):
        n = len(text)
        self.n = n
        self.ends: list[list[tuple[int, int, tuple[int, ...]]]] = [[] for _ in range(n + 1)]
        score, longest, ends = v.score, v.longest, self.ends
        for i in range(n):
            for j in range(i + 1, min(n, i + longest) + 1):
                hit = score.get(text[i:j])
                if hit is not None:
                    ends[j].append((i, hit[0], (hit[1],)))
            if text[i] not in score:
                raw = (MARK if text[i] == LITERAL else text[i]).encode("utf-8", "surrogatepass")
                ends[i + 1].append((i, v.byte_score * len(raw), tuple(v.byte_ids[x] for x in raw)))

    def forward(self) -> list[int]:
        best = [0] * (self.n + 1)
        for j in range(1, self.n + 1):
            best[j] = max(best[i] + s for i, s, _ in self.ends[j])
        return best

    def n_best(self, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The ``n`` best segmentations as ``(score, ids)``, best first (backward A-star)."""
        best = self.forward()
        heap: list[tuple[int, tuple[int, ...], int, int]] = [(-best[self.n], (), self.n, 0)]
        found: list[tuple[int, tuple[int, ...]]] = []
        while heap and len(found) < n:
            f, back, at, gone = heapq.heappop(heap)
            if at == 0:
                found.append((-f, back[::-1]))
                continue
            for i, s, ids in self.ends[at]:
                heapq.heappush(heap, (-(gone + s + best[i]), back + ids[::-1], i, gone + s))
        return found

    def best_two(self) -> tuple[int, tuple[int, ...], int | None]:
        """Score and ids of the best segmentation, and what the second best loses (None: there is none)."""
        best = self.forward()
        ends, at, back = self.ends, self.n, ()
        on_path: set[tuple[int, int]] = set()
        after = [None] * (self.n + 1)
        after[self.n] = 0
        for j in range(self.n, 0, -1):
            if after[j] is not None:
                for i, s, _ in ends[j]:
                    g = after[j] + s
                    if after[i] is None or g > after[i]:
                        after[i] = g
        while at:
            top = min((ids[::-1], i) for i, s, ids in ends[at] if best[i] + s == best[at])
            on_path.add((top[1], at))
            back += top[0]
            at = top[1]
        total, loss = best[self.n], None
        for j in range(1, self.n + 1):
            if after[j] is not None:
                for i, s, _ in ends[j]:
                    if (i, j) not in on_path:
                        d = total - (best[i] + s + after[j])
                        if loss is None or d < loss:
                            loss = d
        return total, back[::-1], loss


class SideBySide:
    """The same search as ``Lattice.best_two`` for many chunks of one length at once (numpy)."""

    def __init__(self, v: Vocabulary):
        n = max(v.longest, TOGETHER) + 1
        self.v = v
        self.powers = np.array([pow(_P, i, 1 << 64) for i in range(n)], np.uint64)[:, None]
        self.inverses = np.array([pow(pow(_P, -1, 1 << 64), i, 1 << 64) for i in range(n)], np.uint64)[:, None]
        pieces = sorted(v.score, key=len)
        self.ids = np.array([v.score[p][1] for p in pieces], np.int64)
        self.scores = np.array([v.score[p][0] for p in pieces] + [_NONE], np.int64)
        if self.ids.max(initial=0) > _MOST_IDS or TOGETHER > 31:
            raise ValueError(f"more than {_MOST_IDS + 1} piece ids")
        self.packed = (self.scores << _CODE) + (np.append(_MOST_IDS - self.ids, 0) << 5)
        same_length = [list(g) for _, g in groupby(pieces, key=len)]
        self.keys = np.concatenate([self._prefixes(self._codes(g))[-1] for g in same_length])
        # slots by some bits of the hash; what finds its slot taken goes to the next table
        self.tables: list[np.ndarray] = []
        left = np.arange(len(pieces))
        while len(left):
            table = np.full(1 << 19, -1, np.int64)
            slot = self._slot(self.keys[left], len(self.tables))
            _, first = np.unique(slot, return_index=True)
            table[slot[first]] = left[first]
            self.tables.append(table)
            left = np.delete(left, first)

    @staticmethod
    def _codes(same_length: list[str]) -> np.ndarray:
        data = "".join(same_length).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(data, np.uint32).reshape(len(same_length), -1).T

    def _prefixes(self, codes: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(codes) + 1, codes.shape[1]), np.uint64)
        np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * self.powers[: len(codes)], axis=0, out=sums[1:])
        return sums

    @staticmethod
    def _slot(h: np.ndarray, table: int) -> np.ndarray:
        return (h * np.uint64(2 * table + 1)) >> np.uint64(45)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 for none.  A piece is in a later table only where its slot was taken before."""
        flat = h.ravel()
        found = self.tables[0][self._slot(flat, 0)]
        left = np.flatnonzero(found >= 0)
        left = left[self.keys[found[left]] != flat[left]]
        for k in range(1, len(self.tables)):
            if not len(left):
                break
            at = self.tables[k][self._slot(flat[left], k)]
            found[left] = at
            left, at = left[at >= 0], at[at >= 0]
            left = left[self.keys[at] != flat[left]]
        found[left] = -1
        return found.reshape(h.shape)

    def solve(self, chunks: list[str]) -> list[tuple[int, tuple[int, ...], int | None] | None]:
        """Per chunk (all of one length): score, ids and loss; None where a character has no piece."""
        n, m = len(chunks[0]), len(chunks)
        sums = self._prefixes(self._codes(chunks))
        longest = min(n, self.v.longest)
        piece = {}
        for length in range(1, longest + 1):
            starts = n - length + 1
            piece[length] = self._find((sums[length:] - sums[:starts]) * self.inverses[:starts])
        score = {k: self.scores[x] for k, x in piece.items()}  # -1, no piece, is the last entry
        # one number per piece, so that the best is a maximum: score, then the smaller id, then its length
        packed = {k: self.packed[x] + k for k, x in piece.items()}
        best, after = np.zeros((n + 1, m), np.int64), np.full((n + 1, m), _NONE, np.int64)
        last_len, last_id = np.zeros((n + 1, m), np.int64), np.zeros((n + 1, m), np.int64)
        shifted = np.zeros((n + 1, m), np.int64)
        for j in range(1, n + 1):
            top = shifted[j - 1] + packed[1][j - 1]
            for k in range(2, min(j, longest) + 1):
                np.maximum(top, shifted[j - k] + packed[k][j - k], out=top)
            best[j] = top >> _CODE
            shifted[j] = best[j] << _CODE
            last_len[j] = top & 31
            last_id[j] = _MOST_IDS - ((top >> 5) & _MOST_IDS)
        after[n] = 0
        for i in range(n - 1, -1, -1):
            for k in range(1, min(n - i, longest) + 1):
                np.maximum(after[i], score[k][i] + after[i + k], out=after[i])
        on_path = np.zeros((n + 1, m), np.int64)  # length of the best path's piece that ends here, 0 where none does
        at, columns = np.full(m, n), np.arange(m)
        steps: list[np.ndarray] = []
        while True:
            step = np.where(at > 0, last_id[at, columns], -1)
            if (step < 0).all():
                break
            steps.append(step)
            on_path[at, columns] = last_len[at, columns]
            at = np.maximum(0, at - last_len[at, columns])
        second = np.full(m, _LOWEST, np.int64)
        for k in range(1, longest + 1):
            s = best[: n - k + 1] + score[k] + after[k:]
            s[on_path[k:] == k] = _LOWEST
            np.maximum(second, s.max(axis=0), out=second)
        whole = (piece[1] >= 0).all(axis=0).tolist()
        paths = np.array(steps[::-1]).T.tolist()
        return [(t, tuple([x for x in p if x >= 0]), t - s if s > _NONE // 2 else None) if ok else None
                for ok, t, s, p in zip(whole, best[n].tolist(), second.tolist(), paths)]


class Encoder:
    def __init__(self, v: Vocabulary, n_best: int):
        self.v, self.n = v, n_best
        self.cache: dict[str, tuple[int, tuple[int, ...], int]] = {}
        self.chunks = re.compile(v.chunk).findall
        self.side = SideBySide(v)

    def _marked(self, text: str) -> list[str]:
        return self.chunks(MARK + text.replace(MARK, LITERAL).replace(" ", MARK))

    def prepare(self, texts: list[str | None]) -> list[list[str]]:
        """The chunks of the texts; those that are not cached yet are searched, those of a length together."""
        cut = [self._marked(t) if t else [] for t in texts]
        met = set(chain.from_iterable(cut))
        new = met.difference(self.cache)
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = met
        by_length: dict[int, list[str]] = {}
        for c in new:
            if len(c) <= TOGETHER:
                by_length.setdefault(len(c), []).append(c)
        for same in by_length.values():
            for at in range(0, len(same), ABREAST):
                part = same[at: at + ABREAST]
                self.cache.update((c, (got[0], got[1], _FAR if got[2] is None else got[2]))
                                  for c, got in zip(part, self.side.solve(part)) if got is not None)
        return cut

    def _chunk(self, c: str) -> tuple[int, tuple[int, ...], int]:
        if len(self.cache) >= 2 * CACHE:
            self.cache.clear()
        score, ids, loss = Lattice(c, self.v).best_two()
        got = self.cache[c] = score, ids, _FAR if loss is None else loss
        return got

    def encode(self, text: str, chunks: list[str] | None = None) -> tuple[list[int], list[tuple[int, list[tuple[int, int, tuple[int, ...]]]]]]:
        """Ids of the best segmentation, and the ``n`` best as ``(score, edits)``: an edit replaces
        ``ids[start:stop]`` of the best by other ids.  ``chunks``: the text's, where :meth:`prepare` has cut it."""
        if not text:
            return [], [(0, [])]
        chunks = chunks or self._marked(text)
        found = list(map(self.cache.get, chunks))
        if None in found:
            found = [got or self.cache.get(c) or self._chunk(c) for c, got in zip(chunks, found)]
        scores, pieces, losses = map(list, zip(*found))
        total, ids = sum(scores), list(chain.from_iterable(pieces))
        close: list[int] = []  # the n - 1 chunks whose second best loses least
        while len(close) < self.n - 1 and (least := min(losses)) < _FAR:
            close.append(losses.index(least))
            losses[close[-1]] = _FAR
        ranked: list[tuple[int, tuple]] = [(0, ())]
        for k in sorted(close):
            start = sum(map(len, pieces[:k]))
            options = Lattice(chunks[k], self.v).n_best(self.n)
            top, own = options[0]
            stop = start + len(own)
            ways = [(0, ())] + [(top - s, ((start, stop, other),)) for s, other in options[1:]]
            ranked = heapq.nsmallest(self.n, ((a + b, x + y) for a, x in ranked for b, y in ways))
        return ids, [(total - loss, list(edits)) for loss, edits in ranked]


EDITS = "array<struct<score:double,edits:array<struct<start:int,stop:int,ids:array<int>>>>>"


def encode(docs: DataFrame, text: str = "text", model: str | Vocabulary = MODEL, n_best: int = N_BEST,
           ids: str = "ids", best: str = "n_best", decoded: str | None = None) -> DataFrame:
    """``docs`` plus ``ids`` (the best segmentation) and ``n_best`` (score and edits of the best, in order).

    ``decoded`` adds the text that :func:`decode` makes of the ids, in the same pass.
    """
    v = load(model) if isinstance(model, str) else model
    ids, best = fresh_name(docs, ids), fresh_name(docs, best)
    more = [fresh_name(docs, decoded)] if decoded else []
    at = [c.lower() for c in docs.columns].index(text.lower())
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(best, T._parse_datatype_string(EDITS)), *(T.StructField(c, T.StringType()) for c in more)])
    edit = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("ids", pa.list_(pa.int32()))])
    kind = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # many tuples and no cycles: the collector would only walk through the cache
        collecting = gc.isenabled()
        gc.disable()
        try:
            yield from encoded(batches)
        finally:
            if collecting:
                gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(v, n_best)

        def prepared(texts: list[str | None]) -> Iterator[tuple[str | None, list[str]]]:
            held: list[str | None] = []
            size = 0
            for i, x in enumerate(texts):
                held.append(x)
                size += len(x or "")
                if size > PREPARE or i == len(texts) - 1:
                    yield from zip(held, encoder.prepare(held))
                    held, size = [], 0

        table = _byte_table(v) if more else []
        for b in parts(batches, at):
            out_ids, out_best, out_text = [], [], []
            for x, chunks in prepared(b.column(at).to_pylist()):
                if x is None:
                    out_ids.append(None)
                    out_best.append(None)
                    out_text.append(None)
                    continue
                own, ranked = encoder.encode(x, chunks)
                if more:
                    out_text.append(_text_of(own, table))
                out_ids.append(pa.array(own, pa.int32()).to_numpy())
                out_best.append([{"score": s / 1e6, "edits": [{"start": i, "stop": j, "ids": o} for i, j, o in edits]}
                                 for s, edits in ranked])
            texts = [pa.array(out_text, pa.string())] if more else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out_ids, pa.list_(pa.int32())), pa.array(out_best, kind), *texts],
                                             [*b.schema.names, ids, best, *more])

    return docs.mapInArrow(run, schema)


def _byte_table(v: Vocabulary) -> list[bytes]:
    return [v.raw.get(i, b"") for i in range(max(v.raw, default=-1) + 1)]


def _text_of(ids: list[int | None], table: list[bytes]) -> str:
    try:
        data = b"".join(map(table.__getitem__, ids)) if not ids or min(ids) >= 0 else None
    except (IndexError, TypeError):
        data = None
    if data is None:  # ids that are null or of no piece
        data = b"".join([table[i] if i is not None and 0 <= i < len(table) else b"" for i in ids])
    return data[data.startswith(b" "):].decode("utf-8", "replace")


def decode(encoded: DataFrame, ids: str = "ids", model: str | Vocabulary = MODEL, out: str = "decoded") -> DataFrame:
    """``encoded`` plus ``out``, the text of the ids (null ids: null)."""
    v = load(model) if isinstance(model, str) else model
    out = fresh_name(encoded, out)
    at = [c.lower() for c in encoded.columns].index(ids.lower())
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _byte_table(v)
        for b in batches:
            texts = [_text_of(x.values.to_pylist(), table) if x.is_valid else None for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, out])

    return encoded.mapInArrow(run, schema)
