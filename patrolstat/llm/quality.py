"""Quality rules as a short-circuit cascade.

Every rule's cost and selectivity are measured on a sample; the rules then run
in order of rejections per second, and a document stops at its first failing
rule.  The verdict is the conjunction of all rules, so the order (and with it
the sample and the timings) decides how much work is done and never the result.

The sample is the documents whose id hash is below a bound set for about
``SAMPLE_DOCS`` of them; only a few sums per rule reach the driver.

Defined results: null and empty texts have no words and are rejected by the
length rule; repeated rows are judged one by one; null ids are kept as they are;
an empty table gives no rows; other columns are kept whatever their names.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, parts

SAMPLE_DOCS = 2_000
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_LETTERS = re.compile(r"[^\W\d_]")


class Text:
    """A text with its features, each computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._have: dict[str, object] = {}

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        have = self._have
        if name not in have:
            have[name] = FEATURES[name](self)
        return have[name]


def _dup_lines(t: Text) -> int:
    lines = [x for x in t.text.split("\n") if _WORDS.search(x)]
    return len(lines) - len(set(lines))


def _repeat_words(t: Text) -> int:
    """Words covered by a 3-word window that occurs twice or more in the text."""
    w = t.words
    windows = list(zip(w, w[1:], w[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, upto = 0, 0
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


FEATURES: dict[str, Callable[[Text], object]] = {
    "words": lambda t: _WORDS.findall(t.text),
    "n_words": lambda t: len(t.words),
    "word_chars": lambda t: sum(map(len, t.words)),
    "n_symbols": lambda t: len(_SYMBOLS.findall(t.text)),
    "n_lines": lambda t: sum(1 for x in t.text.split("\n") if _WORDS.search(x)),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
    "n_lettered": lambda t: sum(1 for x in t.words if _LETTERS.search(x)),
    "n_upper": lambda t: sum(1 for x in t.words if len(x) > 1 and x.isupper()),
}

#: name -> True for a text to reject.  The first two are the base rules.
RULES: dict[str, Callable[[Text], bool]] = {
    "too_short": lambda t: t.n_words < 50,
    "repetitive": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
    "symbols": lambda t: 4 * t.n_symbols > t.n_words,
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words,
    "few_lettered_words": lambda t: 10 * t.n_lettered < 6 * t.n_words,
    "shouting": lambda t: 2 * t.n_upper > t.n_words,
    "duplicate_lines": lambda t: 2 * t.n_dup_lines > t.n_lines,
}
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def estimate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             sample_docs: int = SAMPLE_DOCS) -> dict[str, tuple[float, float]]:
    """Rule -> (seconds a document, share rejected), measured on a sample of documents.

    A rule's time includes the features it needs, measured on a fresh text.
    """
    n = docs.count()
    if not n:
        return {}
    share = min(1.0, sample_docs / n)
    sample = docs.select(F.col(text).cast("string").alias("t"), F.xxhash64(F.col(doc_id), F.lit(7)).alias("h"))
    sample = sample.filter(F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) < share).select("t")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clock = time.perf_counter
        for batch in parts(batches, 0):
            texts = batch.column(0).to_pylist()
            names, cost, hits = [], [], []
            for name, rule in RULES.items():
                t0 = clock()
                bad = sum(rule(Text(x)) for x in texts)
                names.append(name)
                cost.append(clock() - t0)
                hits.append(bad)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(cost, pa.float64()), pa.array(hits, pa.int64()),
                 pa.array([len(texts)] * len(names), pa.int64())], ["rule", "cost", "hits", "n"])

    rows = (sample.mapInArrow(measure, "rule string, cost double, hits long, n long")
            .groupBy("rule").agg(F.sum("cost").alias("cost"), F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect())
    return {r["rule"]: (r["cost"] / r["n"], r["hits"] / r["n"]) for r in rows if r["n"]}


def order_rules(measured: dict[str, tuple[float, float]]) -> list[str]:
    """Rules by rejections per second, most first; unmeasured rules keep their place at the end."""
    known = [r for r in RULES if r in measured]
    known.sort(key=lambda r: -measured[r][1] / max(measured[r][0], 1e-9))
    return known + [r for r in RULES if r not in measured]


def cascade(docs: DataFrame, order: list[str] | None = None, doc_id: str = "doc_id", text: str = "text",
            features: tuple[str, ...] = (), verdict: str = "failed_rule") -> DataFrame:
    """``docs`` plus ``verdict``: the first failing rule in ``order`` (null: kept).

    ``features`` adds those columns for every document; without them a document
    costs only the rules up to its first failure.  A name that ``docs`` has already gets underscores.
    """
    order = order or order_rules(estimate(docs, doc_id, text))
    verdict, columns = fresh_name(docs, verdict), [fresh_name(docs, f) for f in features]
    extra = [T.StructField(verdict, T.StringType()), *(T.StructField(c, T.LongType()) for c in columns)]
    schema = T.StructType([*docs.schema.fields, *extra])
    at = [c.lower() for c in docs.columns].index(text.lower())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, at):
            failed: list[str | None] = []
            values: list[list[int]] = [[] for _ in features]
            for x in batch.column(at).to_pylist():
                t = Text(x)
                failed.append(next((name for name in order if RULES[name](t)), None))
                for out, f in zip(values, features):
                    out.append(getattr(t, f))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(failed, pa.string()), *(pa.array(v, pa.int64()) for v in values)],
                [*batch.schema.names, verdict, *columns])

    return docs.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass every rule, in the input's columns."""
    judged = cascade(docs, doc_id=doc_id, text=text)
    return judged.filter(F.col(judged.columns[-1]).isNull()).drop(judged.columns[-1])
