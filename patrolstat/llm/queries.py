"""The registered queries of this subpackage: thin calls of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat, html_text, importance, jaccard, licenses, merkle, mixing, mixing_lm, pieces, pii, quality,
               suffix_dedup)
from .common import cut, read
from .oracle import ORACLE  # noqa: F401


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``, scored by the model and by the unigram base."""
    return mixing_lm.score(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the cascade's verdict for every whole text of ``documents``."""
    judged = quality.cascade(read(spark, sf_dir, "documents").select("doc_id", "text"), features=quality.BASE_COLUMNS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *quality.BASE_COLUMNS, failed.alias("base_failed"),
                         F.col("failed_rule").isNull().alias("kept"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` as pieces, its N best scores, and the text decoded again."""
    found = pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.transform("n_best", lambda x: x["score"]).alias("scores"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -7, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    rendered = cut(chat.render(turns))
    return chat.read_written(chat.written(rendered, chat.examples(rendered)))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte of ``documents`` that a repeated 200-byte string covers, removed."""
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    return pii.digest(pii.detect(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of ``documents`` linked by 4-word shingles at a similarity of 0.85."""
    return jaccard.classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix of all sources takes."""
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    return ann.search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 100 == 0)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's membership proof in the Merkle manifest of ``documents``, folded again from tampered rows."""
    docs = read(spark, sf_dir, "documents")

    def leaf(n_chars: Column) -> Column:
        return merkle.leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")])

    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
                      leaf(F.col("n_chars").cast("decimal(20,0)") + 1))
    rows = cut(docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), tampered.alias("tampered")))
    made = merkle.manifest(rows, "lang", ["doc_id"], "leaf", keep=["doc_id", "tampered"])
    proved = merkle.prove(made, made.leaves.select("grp", "rank", "row"))
    folded = merkle.folded(F.coalesce("row.tampered", "digest"), F.col("proof"))
    return proved.select("row.doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(made.root).cast("string").alias("root"),
                         merkle.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, weighed towards ``benchmark``; the drawn ones ranked."""
    found = importance.resample(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices, tags and their labels in every whole text of ``documents``."""
    found = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "licence.*")


QUERIES = {
    "op1_context_mixing": op1_context_mixing,
    "op2_quality": op2_quality,
    "op3_pieces": op3_pieces,
    "op4_chat": op4_chat,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_pii": op6_pii,
    "op7_html_text": op7_html_text,
    "op8_jaccard": op8_jaccard,
    "op9_mixing": op9_mixing,
    "op10_ann": op10_ann,
    "op11_merkle": op11_merkle,
    "op12_resample": op12_resample,
    "op13_licenses": op13_licenses,
}
