"""Mixing sources to target weights (native: DataFrame functions only).

The words of a source, laid end to end, are packed into blocks of
``block_words``.  Every output shard of ``shard_slots`` block slots gets
per-source counts: the whole part of the expected count, plus a multinomial
draw for the slots that remain (the residual multinomial, whose counts have the
right expectation and little noise).  A source's slots are numbered through all
shards; slot ``i`` maps to pass ``i div n_blocks`` over the source and, through
a pseudorandom permutation of ``[0, n_blocks)`` keyed by source and pass, to a
block.  Blocks and documents meet in one equi-join on (source, block).

A block is used at most ``max_passes`` times, so no document exceeds that many
times its size.  Everything is a function of the rows and the seed: reruns and
other partitionings agree (rows that are equal in id, source and text are
interchangeable).

Defined results: a null or empty text has size 0 and is never taken; null
sources form one source, ordered last; a null ``doc_id`` is an ordinary id;
repeated rows are separate documents; an empty table gives no rows.  Other
columns of the input, whatever their names, are kept by :func:`mix_documents`.

Hot sources: nothing is grouped by source alone except sums that Spark combines
before the shuffle; running offsets are two-level (bucket sums, then inside a
bucket of about ``bucket_rows`` rows).  Only tables with a row per source or
per (shard, source) are windowed as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

BLOCK_WORDS = 32
SHARD_SLOTS = 16_384
MAX_PASSES = 2
BUCKET_ROWS = 2_000
ROUNDS = 10
SEED = 20_231


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(*parts: Column) -> Column:
    """A hash of the parts as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def permuted(pos: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """``pos`` under a pseudorandom permutation of ``[0, n)`` (swap-or-not rounds).

    In a round every position x has the partner (k - x) mod n; a hash of the
    larger of the two decides for both whether they swap, so each round is a
    permutation for any n, without cycle walking.
    """
    def swap(x: Column, r: Column) -> Column:
        return F.transform(
            F.array(F.pmod(F.xxhash64(*key, r), n)),
            lambda k: F.transform(
                F.array(F.pmod(k - x, n)),
                lambda partner: F.when(
                    F.xxhash64(*key, r, F.greatest(x, partner)) % 2 == 0, x).otherwise(partner)),
        )[0][0]

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), pos, swap)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
                   max_passes: int = MAX_PASSES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: ``sid, _src, n_docs, source_size, target, n_blocks``.

    ``sized`` has ``_src`` and ``_size``.  Sources in code-point order (null
    last) take the weights in rotation and share ``share`` times all sizes;
    a target stops at ``max_passes`` times its source, and what it leaves goes
    to the others by weight.  In order of cap per weight the capped sources
    come first, so the common level is a prefix-sum away: no iteration.
    """
    whole = Window.orderBy(F.col("_src").asc_nulls_last())
    src = (sized.groupBy("_src").agg(F.count("*").alias("n_docs"), F.sum("_size").alias("source_size"))
           .withColumn("sid", F.row_number().over(whole).cast("long") - 1)
           .withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                         (F.col("sid") % len(weights) + 1).cast("int")))
           .withColumn("cap", F.lit(float(max_passes)) * F.col("source_size")))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    everything = Window.partitionBy()
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = ((total - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    src = (src.withColumn("level", level)
           .withColumn("open_from", F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("cap") / F.col("w"))))
    common = F.min(F.when(F.col("open_from").isNotNull(), F.struct("open_from", "sid", "level"))).over(everything)["level"]
    return (src.withColumn("target", F.least(F.col("cap"), F.coalesce(common, F.lit(0.0)) * F.col("w")))
            .withColumn("n_blocks", F.ceil(F.col("source_size") / F.lit(block_words)).cast("long"))
            .select("sid", "_src", "n_docs", "source_size", "target", "n_blocks"))


def draw_slots(targets: DataFrame, shard_slots: int = SHARD_SLOTS, max_passes: int = MAX_PASSES,
               seed: int = SEED) -> DataFrame:
    """The mix: one row per block slot, ``shard, sid, pass, block``."""
    src = F.struct("sid", "n_blocks", (F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks")
                                              / F.col("source_size")).otherwise(0.0)).alias("want"))
    plan = (targets.agg(F.sort_array(F.collect_list(src)).alias("src"))
            .withColumn("all", F.aggregate("src", F.lit(0.0), lambda a, s: a + s["want"]))
            .withColumn("slots", F.round("all").cast("long"))
            .filter("slots > 0")
            .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.floor((F.col("slots") - 1) / shard_slots)))))
    here = F.least(F.lit(shard_slots).cast("long"), F.col("slots") - F.col("shard") * shard_slots)
    plan = (plan.withColumn("here", here)
            .withColumn("expect", F.transform("src", lambda s: s["want"] / F.col("all") * F.col("here")))
            .withColumn("rest", F.col("here") - F.aggregate("expect", F.lit(0).cast("long"),
                                                            lambda a, e: a + F.floor(e).cast("long")))
            # running sums of the fractions: the inverse distribution function of the residual draw
            .withColumn("upto", F.aggregate(
                "expect", F.array().cast("array<double>"),
                lambda a, e: F.concat(a, F.array(F.coalesce(F.element_at(F.when(F.size(a) > 0, a), -1), F.lit(0.0))
                                                 + e - F.floor(e)))))
            .withColumn("drawn", F.transform(
                F.filter(F.sequence(F.lit(0).cast("long"), F.col("rest")), lambda i: i < F.col("rest")),
                lambda i: F.least(F.size("src") - 1, F.size(F.filter(
                    "upto", lambda u: u <= _uniform(F.lit(seed), F.col("shard"), i) * F.element_at("upto", -1))))))
            .select("shard", F.posexplode(F.arrays_zip("src", "expect")).alias("at", "s"), "drawn")
            .select("shard", F.col("s.src.sid").alias("sid"), F.col("s.src.n_blocks").alias("n_blocks"),
                    (F.floor("s.expect").cast("long")
                     + F.size(F.filter("drawn", lambda d: d == F.col("at")))).alias("count")))
    numbered = plan.withColumn("first", F.coalesce(
        F.sum("count").over(Window.partitionBy("sid").orderBy("shard")
                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # a few bytes here become many rows: a fixed number of partitions, which AQE leaves as they are
    parts = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = (numbered.filter("count > 0").repartition(parts, "sid", "shard")
             .select("shard", "sid", "n_blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("i"))
             .filter(F.col("i") < F.col("n_blocks") * max_passes)
             .withColumn("pass", F.floor(F.col("i") / F.col("n_blocks")).cast("long")))
    return slots.select("shard", "sid", "pass", permuted(
        F.pmod("i", "n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("sid"), F.col("pass")).alias("block"))


def _placed(docs: DataFrame, targets: DataFrame, bucket_rows: int) -> DataFrame:
    """Documents with ``sid`` and ``_at``, the offset of their first word in their source."""
    d = docs.join(targets.withColumnRenamed("_src", "_tsrc"), F.col("_src").eqNullSafe(F.col("_tsrc")), "left").drop("_tsrc")
    d = d.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_mark"), F.ceil(F.col("n_docs") / bucket_rows).cast("long")))
    before = (d.groupBy("sid", "_bucket").agg(F.sum("_size").alias("n"))
              .withColumn("_before", F.coalesce(F.sum("n").over(
                  Window.partitionBy("sid").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("sid", "_bucket", "_before"))
    inside = (Window.partitionBy("sid", "_bucket").orderBy("_id", "_mark", "_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (d.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
            .join(before, ["sid", "_bucket"])
            .withColumn("_at", F.col("_before") + F.col("_in")).drop("_bucket", "_before", "_in"))


def _blocks(placed: DataFrame, block_words: int) -> DataFrame:
    """One row per (document, block it touches): ``sid, block, _at, lo, hi`` (words of the document, end exclusive)."""
    first, last = F.floor(F.col("_at") / block_words), F.floor((F.col("_at") + F.col("_size") - 1) / block_words)
    b = (placed.filter("_size > 0").select("sid", "_at", "_size", F.explode(F.sequence(first, last)).alias("block")))
    return b.select("sid", "block", "_at",
                    F.greatest(F.lit(0), F.col("block") * block_words - F.col("_at")).alias("lo"),
                    F.least(F.col("_size"), (F.col("block") + 1) * block_words - F.col("_at")).alias("hi"))


def _prepared(docs: DataFrame, doc_id: str, text: str, source: str, keep: list[Column]) -> DataFrame:
    return docs.select(*keep, F.col(doc_id).cast("string").alias("_id"), F.col(source).cast("string").alias("_src"),
                       n_words(F.col(text)).alias("_size"), F.xxhash64(F.col(text)).alias("_mark"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """How much of every document the mix takes: ``doc_id, size, source_size, target, taken``.

    ``taken`` counts words, repeats included.  The narrow table of sizes is
    written once, so the texts are read once.
    """
    sized = cut(_prepared(docs, doc_id, text, source, [F.col(doc_id).alias("doc_id")]))
    targets = cut(source_targets(sized, block_words=block_words))
    placed = cut(_placed(sized, targets, BUCKET_ROWS))
    times = draw_slots(targets, shard_slots, seed=seed).groupBy("sid", "block").agg(F.count("*").alias("times"))
    # the planner sees only the few bytes of ``targets`` below the slots: hints keep what grows out of broadcasts
    taken = (_blocks(placed, block_words).join(times.hint("merge"), ["sid", "block"])
             .groupBy("sid", "_at").agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken")))
    out = placed.withColumn("_key", F.when(F.col("_size") > 0, F.col("_at")))
    return (out.join(taken.withColumnRenamed("_at", "_key").hint("merge"), ["sid", "_key"], "left")
            .select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                  block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mixed corpus, in the input's columns: one row per document and pass that takes any of it.

    The text holds the words the pass takes, in order, each with the white
    space that follows it (the white space before the first word goes with
    word one); a document taken whole keeps its text unchanged.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    col = dict(zip([c.lower() for c in docs.columns], names))
    # written with a number for every row: the way back is a join on it, which moves the texts once
    full = cut(_prepared(plain, col[doc_id.lower()], col[text.lower()], col[source.lower()],
                         [F.col(n) for n in names]).withColumn("_row", F.monotonically_increasing_id()))
    targets = cut(source_targets(full.select("_src", "_size"), block_words=block_words))
    placed = cut(_placed(full.select("_row", "_id", "_src", "_mark", "_size"), targets, BUCKET_ROWS))
    runs = (_blocks(placed, block_words).join(draw_slots(targets, shard_slots, seed=seed).hint("merge"), ["sid", "block"])
            .groupBy("sid", "_at", "pass").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"),
                                               F.sum(F.col("hi") - F.col("lo")).alias("n")))
    taken = (placed.filter("_size > 0").select("_row", "_size", "sid", "_at").join(runs.hint("merge"), ["sid", "_at"])
             .select("_row", "runs", (F.col("n") == F.col("_size")).alias("_all")))
    t = F.col(col[text.lower()])
    words = F.regexp_extract_all(t, F.lit(r"(?:^[\x20\x09-\x0D]+)?" + WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    out = (full.select(*names, "_row").join(taken.hint("merge"), "_row")
           .withColumn("_words", words)
           .withColumn("_new", F.when(F.col("_all"), t).otherwise(F.array_join(F.flatten(F.transform(
               "runs", lambda r: F.slice("_words", (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")))), ""))))
    chars = col.get("n_chars")
    cols = [F.col("_new").alias(o) if n == col[text.lower()]
            else F.length("_new").cast("long").alias(o) if n == chars else F.col(n).alias(o)
            for o, n in zip(docs.columns, names)]
    return out.select(*cols)
