"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its
context and only its reply is trainable.  Turns after the last assistant turn
(or a conversation without one) give one closing example with a context and no
target, so nothing of a conversation is lost.

The template writes a turn as ``<|turn:ROLE|>`` + text + ``<|end|>``.  Roles and
texts are escaped reversibly: every ``~`` becomes ``~0`` and every ``<`` becomes
``~1``; afterwards no text can hold a control string (``<|...|>``), nor the
control strings of other templates that start with ``<`` (``</s>``); ``[`` and
``]`` become ``~2`` and ``~3`` for the bracketed ones (``[INST]``); a ``|``
in a role becomes ``~4``.

A rendered conversation has a prefix for every example, so contexts are prefixes
of one text.  ``render`` keeps a row per turn with its offsets, ``examples`` names
the examples (last turn, length, loss span) and ``written`` writes every one of them
out whole, context and target.  Examples beyond ``PART_CHARS`` characters go on in
further rows, and the parts of a conversation are dealt to different tasks; so a long
conversation, whose examples together are as large as the square of its length, is
never held in one row or one task.  ``expand`` writes a row per example whatever its length.

Turns are ordered by ``turn`` (null first), then role, then text, so ties and
repeated rows have a defined order; all of them are kept.  A null text is an
empty text, a null role is written as an empty role; a null ``conv_id`` is one
conversation of its own; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_OPEN, TURN_CLOSE, TURN_END = "<|turn:", "|>", "<|end|>"
TRAINABLE = "assistant"
#: Characters at which an example goes on in a further row, behind the segment that reaches them.
PART_CHARS = 1 << 16
#: Fixed pairs of the escape, applied first to last (undone last to first).
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("]", "~3"), ("|", "~4"))


def escape(text: Column) -> Column:
    for raw, coded in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for raw, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(raw))
    return text


def _ordered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, n, turn, role, text``: turns numbered from 0 in each conversation."""
    t = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return t.withColumn("n", F.row_number().over(
        Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long") - 1)


def render(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row per turn of the formatted corpus.

    Columns: ``conv_id``, ``n`` (place of the turn), ``segment`` (its formatted
    string), ``start`` (offset of the segment in the rendered conversation),
    ``trainable``, ``loss_start`` and ``loss_end`` (the masked-in characters,
    offsets in the rendered conversation; equal where nothing is trained) and
    ``example`` (number of the example the turn is first needed in).  Example
    ``e`` is the concatenation of all segments up to its target, and only the
    span of its target counts for the loss.
    """
    t = _ordered(turns, conv_id, turn, role, text)
    w = Window.partitionBy("conv_id").orderBy("n")
    body = escape(F.col("text"))
    head = F.concat(F.lit(TURN_OPEN), escape(F.col("role")), F.lit(TURN_CLOSE))
    t = (t.withColumn("head", head).withColumn("body", body)
         .withColumn("segment", F.concat("head", "body", F.lit(TURN_END)))
         .withColumn("trainable", F.col("role") == TRAINABLE)
         .withColumn("start", F.coalesce(F.sum(F.length("segment").cast("long")).over(
             w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("loss_start", F.col("start") + F.length("head"))
         .withColumn("loss_end", F.col("loss_start") + F.when(F.col("trainable"), F.length("body")).otherwise(0))
         .withColumn("example", F.coalesce(F.sum(F.col("trainable").cast("long")).over(
             w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return t.select("conv_id", "n", "segment", "start", "trainable", "loss_start", "loss_end", "example")


def examples(rendered: DataFrame) -> DataFrame:
    """The examples by reference: ``conv_id, example, last, end, loss_start, loss_end``.

    One row per assistant turn, whose example is the segments up to ``last`` (``end`` characters), with
    only the span of its reply trainable; a closing row without a target where turns follow the
    last assistant turn.  ``written`` makes their texts.
    """
    is_last = F.col("n") == F.max("n").over(Window.partitionBy("conv_id"))
    # lengths before the window: the segments themselves stay out of its shuffle
    ends = rendered.select("conv_id", "n", "example", "trainable", (F.col("start") + F.length("segment")).alias("end"),
                           "loss_start", "loss_end")
    return ends.withColumn("is_last", is_last).filter(F.col("trainable") | F.col("is_last")).select(
        "conv_id", "example", F.col("n").alias("last"), "end", "loss_start", "loss_end")


def written(rendered: DataFrame, refs: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """The expansion: ``conv_id, example, part, start, text, loss_start, loss_end, longest``.

    Every example of ``refs`` with its whole context and its target: its ``text`` in a row or, in order of
    ``part``, in several, cut between segments (``start``: place of the row's text in the example; loss spans
    are places in the example).  ``longest`` marks the conversation's longest example.  Segments are put
    together once, by part; each example takes all parts in front of its end, the last one up to there.
    """
    conv = F.struct("conv_id")  # equal where both are null
    blocks = (rendered.groupBy(conv.alias("conv"), F.floor(F.col("start") / part_chars).alias("part")).agg(
        F.min("start").alias("start"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "segment"))), lambda s: s["segment"]), "").alias("whole"))
        .withColumn("chars", F.length("whole")))
    longest = F.col("last") == F.max("last").over(Window.partitionBy("conv_id"))
    wanted = (refs.withColumn("longest", longest).withColumn("conv", conv)
              .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("end") - 1) / part_chars)))))
    here = F.col("end") - F.col("start")
    # short rows here become texts: a fixed number of partitions, which AQE leaves as they are
    tasks = int(rendered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (wanted.repartition(tasks, "conv", "part").join(blocks.hint("merge"), ["conv", "part"]).filter(here > 0)
            .select("conv_id", "example", "part", "start",
                    F.when(here >= F.col("chars"), F.col("whole")).otherwise(
                        F.substr("whole", F.lit(1), F.least(here, F.col("chars")).cast("int"))).alias("text"),
                    "loss_start", "loss_end", "longest"))


def expand(rendered: DataFrame) -> DataFrame:
    """Whole examples: ``conv_id, example, text, loss_start, loss_end``.

    One row per assistant turn, with everything before it as context; a closing
    row without a target (``loss_start = loss_end``) where turns follow the last
    assistant turn.  The output is as large as the training format makes it:
    the sum of all prefixes.
    """
    so_far = Window.partitionBy("conv_id").orderBy("n")
    last = Window.partitionBy("conv_id")
    e = (rendered.withColumn("prefix", F.collect_list("segment").over(so_far))
         .withColumn("is_last", F.col("n") == F.max("n").over(last))
         .filter(F.col("trainable") | F.col("is_last")))
    return e.select("conv_id", "example", F.array_join("prefix", "").alias("text"), "loss_start", "loss_end")


def _turns(text: Column) -> Column:
    """The turns (role, text) that whole segments side by side hold."""
    return F.transform(F.filter(F.split(text, r"<\|end\|>", -1), lambda s: s != ""), lambda s: F.struct(
        unescape(F.substring_index(F.substr(s, F.lit(len(TURN_OPEN) + 1)), TURN_CLOSE, 1)).alias("role"),
        unescape(F.substr(s, F.locate(TURN_CLOSE, s) + len(TURN_CLOSE))).alias("text")))


def _said(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples' text and masks alone: the contract's columns.

    All turns are parsed from a conversation's longest example; the trained text
    is what stands under the masks, in the order of the examples.
    """
    e = examples.withColumn("trained", unescape(F.substr(
        F.col("text"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))))
    g = (e.groupBy("conv_id").agg(
        F.max_by("text", F.col("example")).alias("text"),
        F.sort_array(F.collect_list(F.struct("example", "trained"))).alias("parts"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"))
        .withColumn("turns", _turns(F.col("text")))
        .withColumn("loss", F.array_join(F.transform("parts", lambda p: p["trained"]), "")))
    return g.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(_said(F.col("turns")), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars")


def read_written(examples: DataFrame) -> DataFrame:
    """What ``read_back`` gives, from the rows of ``written``: their texts and masks alone.

    A part holds whole segments, so turns are parsed part by part; a target and its mask stand in
    the last part of their example.  Lengths are those of all texts.
    """
    within = F.col("loss_start") - F.col("start")
    masked = (F.col("loss_end") > F.col("loss_start")) & (within >= 0) & (within < F.col("chars"))
    rows = (examples.withColumn("chars", F.length("text").cast("long"))
            .withColumn("turns", F.when(F.col("longest"), _turns(F.col("text"))))
            .select("conv_id", "chars", F.when(F.col("longest"), F.size("turns")).alias("n_turns"),
                    F.when(F.col("longest"), F.struct("part", _said(F.col("turns")).alias("text"))).alias("said"),
                    F.when(masked, F.struct("example", unescape(F.substr(
                        F.col("text"), (within + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))).alias("text")))
                    .alias("trained")))

    def joined(column: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(column)), lambda p: p["text"]), "")

    g = rows.groupBy("conv_id").agg(F.sum("n_turns").alias("n_turns"), joined("said").alias("turns"), joined("trained").alias("loss"),
                                    F.sum("chars").alias("formatted_chars"))
    return g.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2("turns", 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def read_back_examples(rendered: DataFrame, refs: DataFrame) -> DataFrame:
    """What ``read_back`` gives for whole examples, from their references: a check of ``examples`` that writes no texts.

    An example meets the segments that it is the first to show (those after the example before, up to its
    own target), so every segment is read once: turns are parsed from the segments, the trained text
    is cut from the target's segment at the example's loss span, and lengths are the examples' ends.
    """
    head_end = F.locate(TURN_CLOSE, F.col("segment"))
    same = refs.select(F.col("conv_id").alias("e_conv"), F.col("example").alias("e_example"), "last", "end",
                       F.col("loss_start").alias("e_start"), F.col("loss_end").alias("e_end"))
    shown = rendered.select("conv_id", "example", "n", "start", "segment").join(
        same, F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("example") == F.col("e_example")))
    target = F.col("n") == F.col("last")
    rows = shown.filter(F.col("n") <= F.col("last")).select(
        "conv_id", "n", F.when(target, F.col("end")).alias("end"),
        F.concat(unescape(F.substring_index(F.substr("segment", F.lit(len(TURN_OPEN) + 1)), TURN_CLOSE, 1)), F.lit("\n"),
                 unescape(F.substr("segment", head_end + len(TURN_CLOSE),
                                   F.length("segment") - head_end - len(TURN_CLOSE) - len(TURN_END) + 1)), F.lit("\n")).alias("said"),
        F.when(target, unescape(F.substr("segment", (F.col("e_start") - F.col("start") + 1).cast("int"),
                                         (F.col("e_end") - F.col("e_start")).cast("int")))).otherwise("").alias("trained"))

    def joined(column: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", column))), lambda p: p[column]), "")

    g = rows.groupBy("conv_id").agg(F.count("*").alias("n_turns"), joined("said").alias("turns"), joined("trained").alias("loss"),
                                    F.sum("end").alias("formatted_chars"))
    return g.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))
