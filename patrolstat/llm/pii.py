"""Personal data: patterns propose, validators confirm, context adjusts (native).

Every kind has a pattern, an optional validator (a span that fails it is
dropped) and a score.  A span's score is its kind's prior, plus ``VALID_BONUS``
if a checksum or range test confirmed it,
plus ``CONTEXT_BONUS`` if one of the kind's context words stands within
``WINDOW`` characters before it or ``WINDOW // 2`` after it.  Spans of at least
``THRESHOLD`` are reported.  The four base kinds (email, ip, card, phone) start
above the threshold, so validators alone decide them; the further kinds (iban,
ssn) need their checksum or their context.

Matches are found leftmost and non-overlapping per kind, over the whole text,
in code points.  ``split`` and ``regexp_extract_all`` of the same pattern give
the text between matches and the matches; their lengths add up to positions, so
no Python is needed.  The patterns are possessive and anchored at the start of a
run (or the end of the last match): equal matches, linear time in long runs.

Defined results: null and empty texts have no spans; repeated rows are
separate documents; spans of different kinds may overlap; an empty table gives
no rows; other columns of the input are kept whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_name

THRESHOLD = 0.5
VALID_BONUS = 0.4
CONTEXT_BONUS = 0.3
WINDOW = 40
#: What is kept of a gap behind a match, and how many of the next pieces make its context.
AHEAD, NEXT = 80, 5

SPAN = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,score:double>>"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def ip_parts_valid(s: Column) -> Column:
    """Four parts, each at most 255 (leading zeros allowed)."""
    def fits(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(s, r"\."), fits)


def luhn_valid(s: Column) -> Column:
    """12 to 19 digits whose Luhn sum is a multiple of ten.

    Padded to 20 digits (zeros add nothing), every second digit from the right
    is replaced by the digit sum of its double.
    """
    d = _digits(s)
    padded = F.lpad(d, 20, "0")
    plain = F.aggregate(F.sequence(F.lit(2), F.lit(20), F.lit(2)), F.lit(0),
                        lambda a, i: a + F.substr(padded, i, F.lit(1)).cast("int"))
    twice = F.translate(padded, "0123456789", "0246813579")
    double = F.aggregate(F.sequence(F.lit(1), F.lit(19), F.lit(2)), F.lit(0),
                         lambda a, i: a + F.substr(twice, i, F.lit(1)).cast("int"))
    return F.length(d).between(12, 19) & ((plain + double) % 10 == 0)


def phone_valid(s: Column) -> Column:
    return F.length(_digits(s)).between(9, 15)


def iban_valid(s: Column) -> Column:
    """mod-97 of the rearranged account number is one (letters count 10 to 35)."""
    c = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substr(c, F.lit(5)), F.substr(c, F.lit(1), F.lit(4)))
    code = lambda ch: F.when(ch.between("0", "9"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
    rest = F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), lambda a, i: (
        a * F.when(F.substr(turned, i, F.lit(1)).between("0", "9"), 10).otherwise(100)
        + code(F.substr(turned, i, F.lit(1)))) % 97)
    return F.length(c).between(15, 34) & (rest == 1)


def iban_cut(s: Column) -> Column:
    """The longest leading part of whole groups, with or without the tail, that is a valid account number; else null.

    The pattern may take a word of upper-case letters or digits that follows the number.
    """
    groups = F.regexp_extract_all(s, F.lit(r"[A-Z]{2}[0-9]{2}|\x20?[A-Z0-9]{4}|\x20?[A-Z0-9]{1,3}"), F.lit(0))
    starts = F.transform(F.sequence(F.size(groups), F.lit(3), F.lit(-1)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), ""))
    # a part ends where a word ends
    ends = F.filter(starts, lambda p: iban_valid(p) & ~F.substr(s, F.length(p) + 1, F.lit(1)).rlike("[A-Z0-9]"))
    return F.when(s.isNotNull(), F.get(ends, F.lit(0)))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    prior: float
    valid: Callable[[Column], Column] | None = None
    checked: bool = False           # the validator is evidence enough for VALID_BONUS
    context: str = ""               # alternatives of context words, lower case
    cut: Callable[[Column], Column] | None = None  # the pattern matches a start with the rest as a group ahead: what of both is meant
    hint: str = ""                  # a literal every match contains: texts without it are not scanned


#: Order matters: ties in a span's start are listed in this order.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.6,
         context="mail|contact|write", hint="@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", 0.5, ip_parts_valid, True, context="ip|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.5, luhn_valid, True, context="card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, phone_valid, context="tel|phone|call|mobile|fax", hint="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))", 0.3,
         iban_valid, True, context="iban|account|konto|compte|cuenta", cut=iban_cut),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3,
         lambda s: ~s.rlike("^(000|666|9)|-00-|-0000$"), context="ssn|social security|social-security"),
)
BASE = ("email", "ip", "card", "phone")
RANK = {k.name: i for i, k in enumerate(KINDS)}


def kind_spans(text: Column, kind: Kind) -> Column:
    """All reported spans of one kind, in order, as ``array<struct>``.

    The context of a match is put together from the pieces next to it (the end of what was passed, the next
    gaps and matches), so a text costs its length and its matches, not their product.  An aggregate copies
    its state at every step: spans are gathered in runs of about the root of their number.
    """
    none = F.array().cast(SPAN)
    heads = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    rests = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1)) if kind.cut is not None else heads
    bonus = VALID_BONUS if kind.checked else 0.0
    state, runs = f"struct<at:bigint,tail:string,last:bigint,out:{SPAN}>", f"struct<at:bigint,tail:string,last:bigint,out:array<{SPAN}>>"

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["gap"])
        size = F.coalesce(F.length(m["hit"]), F.lit(0))
        tail = F.right(F.concat(acc["tail"], F.right(m["gap"], F.lit(WINDOW))), F.lit(WINDOW))
        near = F.lower(F.concat(tail, F.left(F.concat(m["head"], m["ahead"]), size + WINDOW // 2)))
        score = F.lit(kind.prior + bonus) + F.when(near.rlike(rf"\b(?:{kind.context})"), CONTEXT_BONUS).otherwise(0.0)
        span = F.struct(start.alias("start"), F.lit(RANK[kind.name]).alias("kind_no"), (start + size).alias("end"),
                        F.lit(kind.name).alias("kind"), F.least(score, F.lit(1.0)).alias("score"))
        keep = m["hit"].isNotNull() & (kind.valid(m["hit"]) if kind.valid is not None else F.lit(True))
        if kind.name not in BASE:
            keep = keep & (score >= THRESHOLD)
        if kind.cut is not None:  # every start is tried; those inside a span found are its own text
            keep = keep & (acc["last"] <= start)
        return F.struct((start + F.length(m["head"])).alias("at"),
                        F.right(F.concat(tail, F.right(m["head"], F.lit(WINDOW))), F.lit(WINDOW)).alias("tail"),
                        F.when(keep, start + size).otherwise(acc["last"]).alias("last"),
                        F.when(keep, F.concat(acc["out"], F.array(span).cast(SPAN))).otherwise(acc["out"]).alias("out"))

    def scanned(p: Column) -> Column:
        def piece(head: Column, i: Column) -> Column:
            ahead = [F.left(F.coalesce(F.get(p["gaps"], i + 1), F.lit("")), F.lit(AHEAD))]
            for k in range(1, NEXT):  # matches are short and may stand close together
                ahead += [F.coalesce(F.get(p["heads"], i + k), F.lit("")), F.left(F.coalesce(F.get(p["gaps"], i + k + 1), F.lit("")), F.lit(AHEAD))]
            hit = kind.cut(F.concat(head, F.get(p["rests"], i))) if kind.cut is not None else head
            return F.struct(F.get(p["gaps"], i).alias("gap"), head.alias("head"), hit.alias("hit"), F.concat(*ahead).alias("ahead"))

        found = F.transform(p["heads"], piece)
        return F.get(F.transform(F.array(F.struct(found.alias("m"), F.ceil(F.sqrt(F.size(found))).cast("int").alias("run"))), gathered), F.lit(0))

    def gathered(q: Column) -> Column:
        def run(acc: Column, i: Column) -> Column:
            begin = F.struct(acc["at"].alias("at"), acc["tail"].alias("tail"), acc["last"].alias("last"), none.alias("out")).cast(state)
            done = F.aggregate(F.slice(q["m"], i * q["run"] + 1, q["run"]), begin, step)
            return F.get(F.transform(F.array(done), lambda d: F.struct(
                d["at"].alias("at"), d["tail"].alias("tail"), d["last"].alias("last"),
                F.concat(acc["out"], F.array(d["out"])).alias("out"))), F.lit(0))

        zero = F.lit(0).cast("long")
        start = F.struct(zero.alias("at"), F.lit("").alias("tail"), zero.alias("last"), F.array().cast(f"array<{SPAN}>").alias("out")).cast(runs)
        return F.flatten(F.aggregate(F.filter(F.sequence(F.lit(0), q["run"]), lambda i: i * q["run"] < F.size(q["m"])), start, run)["out"])

    # one element, so that the pieces are cut once and then used by name
    cut = F.struct(F.split(text, kind.pattern, -1).alias("gaps"), heads.alias("heads"), rests.alias("rests"))
    spans = F.get(F.transform(F.array(cut), scanned), F.lit(0))
    hit = F.contains(text, F.lit(kind.hint)) if kind.hint else F.regexp_like(text, F.lit(kind.pattern))
    return F.when(hit, spans).otherwise(none)


def detect(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` plus ``out`` (with underscores added where the name is taken): all spans by start, then kind,
    as structs ``(start, kind_no, end, kind, score)``; ends are exclusive, in code points."""
    t, out = F.coalesce(docs[text], F.lit("")), fresh_name(docs, out)
    return docs.withColumn(out, F.sort_array(F.flatten(F.array(*[kind_spans(t, k) for k in KINDS]))))


def mask(docs: DataFrame, text: str = "text", chars: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``; overlapping spans become one, named by the first.

    ``chars`` names a column that holds the text's length and follows it.
    """
    spans = fresh_name(docs, "__pii_spans__")
    found = detect(docs, text, spans)
    t, kind = F.col(f"`{text}`"), "struct<at:bigint,out:string>"

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(t, (acc["at"] + 1).cast("int"), F.greatest(F.lit(0), s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.concat(
            acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")).cast(kind), step,
                       lambda acc: F.concat(acc["out"], F.substr(t, (acc["at"] + 1).cast("int"))))
    found = found.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(t)).drop(spans)
    return found.withColumn(chars, F.length(t).cast("long")) if chars else found


def _of_kind(name: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == name


def digest(found: DataFrame, doc_id: str = "doc_id", spans: str = "spans") -> DataFrame:
    """The contract's columns from detected spans."""
    def listed(arr: Column) -> Column:
        return F.array_join(F.transform(arr, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter(spans, lambda s: s["kind_no"] < len(BASE))
    counts = [F.size(F.filter(spans, _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(F.col(doc_id).alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col(spans)).alias("spans"))
