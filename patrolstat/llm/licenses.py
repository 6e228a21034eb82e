"""Licence scan: Aho-Corasick over the words of a text, licence expressions by a shunting-yard parser.

One automaton holds the notice phrases and the words of the identifier tags; a
text's words (A-Z folded, other ASCII characters that are not letters or digits
separate) are joined by one space and read through it once.  Every place of a
phrase is found, overlapping ones too.

* A **phrase** place gives its label.  Phrases that stand next to each other,
  joined by ``or`` / ``and``, make one expression ("the MIT License or the Apache
  License"); where one place lies inside a longer one, the longer one is its term.
* An **identifier tag** (``SPDX-License-Identifier: MIT OR Apache-2.0``) is
  followed in its line by an expression of identifiers, ``AND``, ``OR``, ``WITH``
  and brackets.  ``AND`` binds stronger than ``OR``, ``WITH`` strongest.

The parser turns a token list into postfix order, and the postfix order is
evaluated twice: to the labels named, and to whether the terms can be met by
licences of ``PERMISSIVE`` alone (all sides of ``and``, any side of ``or``; a
licence with an exception of ``LINKING_EXCEPTIONS`` counts as permissive).

``score``: each label has the strength of its best evidence (identifier tag 1.0;
phrase after a cue such as "licensed under" 0.9; phrase alone 0.5; an expression
that does not parse 0.3); the score is 1 minus the product of what is left.

Defined results: null and empty texts have no words, places or labels and score
0; very long texts are read whole; repeated rows are judged one by one; an empty
table gives no rows; other columns are kept whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import fresh_name, parts

#: The base phrases: label -> words.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
#: More notices (words as they stand after folding), with their labels.
NOTICES = {
    "lesser general public license": "lgpl", "library general public license": "lgpl", "affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "eclipse distribution license": "bsd",
    "european union public licence": "eupl", "bsd license": "bsd", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd",
    "2 clause bsd": "bsd", "3 clause bsd": "bsd", "new bsd": "bsd", "isc license": "isc", "zlib license": "zlib",
    "boost software license": "bsl", "artistic license": "artistic", "this is free and unencumbered software": "unlicense",
    "cc0": "cc0", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by", "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa", "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd", "all rights reserved": "all-rights-reserved",
}
#: Words that announce a notice.
CUES = ("licensed under", "released under", "distributed under", "available under", "under the terms of", "governed by")
#: Words of the tags whose line goes on with an expression.
TAGS = ("spdx license identifier", "license expression", "spdx license expression")
#: Beginnings of identifiers, longest first where one begins another, with their labels.
FAMILIES = (("apache", "apache"), ("mit", "mit"), ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("mpl", "mpl"), ("epl", "epl"),
            ("eupl", "eupl"), ("bsd", "bsd"), ("0bsd", "bsd"), ("isc", "isc"), ("zlib", "zlib"), ("bsl", "bsl"), ("artistic", "artistic"),
            ("unlicense", "unlicense"), ("cc0", "cc0"), ("cc-by-nc-sa", "cc-by-nc-sa"), ("cc-by-nc-nd", "cc-by-nc-nd"),
            ("cc-by-nc", "cc-by-nc"), ("cc-by-sa", "cc-by-sa"), ("cc-by-nd", "cc-by-nd"), ("cc-by", "cc-by"))
PERMISSIVE = frozenset(("mit", "apache", "bsd", "isc", "zlib", "bsl", "artistic", "unlicense", "cc0", "cc-by"))
LINKING_EXCEPTIONS = frozenset(("classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception", "linux-syscall-note"))
TAG, NOTICE, MENTION, BROKEN = 1.0, 0.9, 0.5, 0.3
#: A cue counts within so many words before a phrase; connected phrases lie at most so many words apart.
CUE_REACH, JOIN_REACH = 8, 6

_PRIORITY = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+_:-]+|[^\s]")
_PLAIN = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+_:-]*")
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def label_of(identifier: str) -> str:
    """The label of a licence identifier: its family, else the identifier in lower case."""
    low = identifier.lower()
    return next((label for start, label in FAMILIES if low == start or low.startswith((start + "-", start + "+", start + "v"))), low)


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: identifiers, ``and`` / ``or`` / ``with`` (any case) and brackets to postfix order; None where malformed."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in tokens:
        op = token.lower()
        if op in _PRIORITY:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and _PRIORITY[waiting[-1]] >= _PRIORITY[op]:
                out.append(waiting.pop())
            waiting.append(op)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            waiting.append(token)
        elif token == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif operand_next and _PLAIN.fullmatch(token):
            out.append(token)
            operand_next = False
        else:
            return None
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> tuple[list[str], bool] | None:
    """Labels in order of appearance, and whether permissive licences alone meet the terms; None where ``with`` joins more than names."""
    stack: list[tuple[list[str], bool, str | None]] = []
    for token in postfix:
        if token not in _PRIORITY:
            label = label_of(token)
            stack.append(([label], label in PERMISSIVE, token))
            continue
        (right, free_r, name_r), (left, free_l, name_l) = stack.pop(), stack.pop()
        if token == "with":
            if name_l is None or name_r is None:
                return None
            stack.append((left, free_l or name_r.lower() in LINKING_EXCEPTIONS, None))
        else:
            stack.append((left + right, free_l and free_r if token == "and" else free_l or free_r, None))
    labels, free, _ = stack[0]
    return labels, free


class Scanner:
    """The automaton and the reading of one text."""

    def __init__(self):
        found: dict[str, list[tuple[str, str]]] = {}
        for label, phrase in BASE.items():
            found.setdefault(phrase, []).append(("base", label))
        for phrase, label in NOTICES.items():
            found.setdefault(phrase, []).append(("notice", label))
        for phrase in CUES:
            found.setdefault(phrase, []).append(("cue", ""))
        for phrase in TAGS:
            found.setdefault(phrase, []).append(("tag", ""))
        self.automaton = ahocorasick.Automaton()
        for phrase, kinds in found.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, kinds))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> dict:
        """The columns of :func:`scan` for one text."""
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
        words = raw.split()
        line = " " + b" ".join(words).decode("latin-1") + " "
        hits: list[tuple[int, int, str, str]] = []  # first word, words, kind, label
        at, n = 0, 0
        starts: list[tuple[int, int, list]] = []
        for end, (size, width, kinds) in self.automaton.iter(line):
            starts.append((end - size + 1, width, kinds))
        starts.sort(key=lambda s: s[:2])
        for begin, width, kinds in starts:
            n += line.count(" ", at, begin)  # counted on from the place before: linear in the text
            at = begin
            hits += [(n, width, kind, label) for kind, label in kinds]
        result = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "",
                  "score": 0.0, "permissive": None, "expressions": []}
        if not hits:
            return result
        base = [h for h in hits if h[2] == "base"]
        strength: dict[str, float] = {}
        verdicts: list[bool] = []
        for labels, free, value, shown in [*self._notices(hits, words), *self._tagged(hits, text or "")]:
            for label in labels:
                strength[label] = max(strength.get(label, 0.0), value)
            verdicts.append(free)
            result["expressions"].append(shown)
        for h in base:
            strength.setdefault(h[3], MENTION)
        left = 1.0
        for label in sorted(strength):
            left *= 1.0 - strength[label]
        result |= {"n_base": len(base), "base_labels": ",".join(sorted({h[3] for h in base})), "labels": ",".join(sorted(strength)),
                   "score": round(1.0 - left, 9), "permissive": all(verdicts) if verdicts else None}
        if base:
            result |= {"first_word": base[0][0], "last_word": base[-1][0]}
        return result

    @staticmethod
    def _notices(hits, words) -> Iterator[tuple[list[str], bool, float, str]]:
        """Phrases as expressions: neighbours joined by ``or`` / ``and`` are one."""
        cues = [h[0] + h[1] for h in hits if h[2] == "cue"]
        terms: list[tuple[int, int, str]] = []
        for first, width, kind, label in sorted((h for h in hits if h[2] in ("base", "notice")), key=lambda h: (h[0], -h[1])):
            if not terms or first >= terms[-1][1]:
                terms.append((first, first + width, label))
            elif first + width > terms[-1][1] and width > terms[-1][1] - terms[-1][0]:
                terms[-1] = (first, first + width, label)  # a longer phrase that begins inside a shorter one
        groups: list[list] = []
        for first, end, label in terms:
            gap = words[groups[-1][-1][1]:first] if groups and first - groups[-1][-1][1] <= JOIN_REACH else []
            joint = "or" if b"or" in gap else "and" if b"and" in gap else None
            if joint:
                groups[-1] += [(joint,), (first, end, label)]
            else:
                groups.append([(first, end, label)])
        c = 0
        for group in groups:
            tokens = [g[-1] for g in group]
            labels, free = evaluate(to_postfix(tokens))
            while c + 1 < len(cues) and cues[c + 1] <= group[0][0]:
                c += 1
            cued = bool(cues) and 0 <= group[0][0] - cues[c] <= CUE_REACH
            yield labels, free, NOTICE if cued else MENTION, " ".join(tokens)

    @staticmethod
    def _tagged(hits, text) -> Iterator[tuple[list[str], bool, float, str]]:
        """Expressions behind identifier tags, to the end of their line."""
        if not any(h[2] == "tag" for h in hits):
            return
        for m in re.finditer(r"(?i)license[ \t-]*(?:identifier|expression)[\"']?[ \t]*[:=][ \t]*([^\r\n]*)", text):
            shown = m[1].strip().strip("\"',;*/-<>!# \t")
            tokens = _TOKEN.findall(shown)
            postfix = to_postfix(tokens)
            known = evaluate(postfix) if postfix else None
            if known:
                yield known[0], known[1], TAG, shown
            else:
                names = [label_of(t) for t in tokens if _PLAIN.fullmatch(t)]
                yield [x for x in names if any(x == label for _, label in FAMILIES)], False, BROKEN, shown


COLUMNS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("permissive", T.BooleanType()),
    T.StructField("expressions", T.ArrayType(T.StringType()))])


def scan(docs: DataFrame, text: str = "text", out: str = "licence") -> DataFrame:
    """``docs`` plus the struct ``out`` of :data:`COLUMNS` (named ``out`` with underscores added where taken).

    ``expressions``: what was evaluated, notices first; ``permissive``: whether permissive licences alone
    meet all of them (null without any).
    """
    out = fresh_name(docs, out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, COLUMNS)])
    at = docs.columns.index(text)
    arrow = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                       ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("permissive", pa.bool_()),
                       ("expressions", pa.list_(pa.string()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for part in parts(batches, at):
            found = pa.array([scanner.scan(x) for x in part.column(at).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, out])

    return docs.mapInArrow(read, schema)
