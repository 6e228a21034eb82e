"""The corpus pipeline: quality rules, near copies, personal data, source mix, pieces.

``STAGES`` are applied in order; each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``; the last returns each
remaining text as piece ids.

Defined results, in every stage: an empty table gives no rows; very long texts are
read whole; null sources are one source; other columns, whatever their names, go with
their rows up to the last stage, which returns ``doc_id`` and its own columns.  What
holds for nulls, empty texts and repeated rows stands with each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patrolstat.llm import jaccard, mixing, pieces, pii, quality
from patrolstat.llm.common import cut, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule (a short-circuit cascade).

    Null and empty texts have no words and go; rows are judged one by one, so repeated rows share a verdict.
    """
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity 0.8 or more.

    The row with the smallest id stays (null ids last), and of rows with equal id and text one; rows
    without words are linked with nothing and stay.
    """
    return jaccard.keep_representatives(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text.

    Null texts stay null, empty ones empty; repeated rows are masked alike.
    """
    return pii.mask(docs, chars="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, a row per document and pass.

    Null and empty texts have no words and are never taken; repeated rows are separate documents; a null id is kept.
    """
    return mixing.mix_documents(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the best segmentation's ids, the scores of the N best.

    A null text gives null ids, an empty one none; repeated rows are encoded one by one.
    """
    found = pieces.encode(docs.select("doc_id", "text"))
    return found.selectExpr("doc_id", "ids", "cast(size(ids) as bigint) as n_pieces",
                            "transform(n_best, x -> x.score) as scores")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("mixing sources", source_mix),
    ("SentencePiece encoding", piece_ids),
]

#: SQL cannot express the segmentation or the connected classes: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
