"""Multiclass evaluation on (prediction, label) columns as DataFrame aggregations.

Everything starts from one ``groupBy(label, prediction).count()`` (partial
aggregation, k^2 output rows for k classes); the per-label metrics are then
computed on that tiny table, so no metric ever collects predictions to the
driver.  Definitions follow Spark's multiclass metrics: the label universe
is the sorted set of *true* labels; precision is 0 for a label never
predicted; F1 is 0 when precision + recall is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long confusion matrix: (label, prediction, count)."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Wide matrix: a row per label that occurs as either, ascending, with ``counts``, a map from every
    label (ascending) to how often it was predicted; rows sum to the label's support.

    One plan and one pass over the rows: the label list is gathered from the k x k counts inside the
    plan (a window over k rows), not on the driver.
    """
    conf = confusion_counts(pred, label, prediction)
    # a label that is only predicted has a row of its own, with nothing in it
    cells = conf.select(F.inline(F.array(
        F.struct("label", F.col("prediction").alias("p"), F.col("count").alias("n")),
        F.struct(F.col("prediction").alias("label"), F.lit(None).cast("double").alias("p"), F.lit(None).cast("long").alias("n")))))
    found = cells.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.collect_list(F.when(F.col("p").isNotNull(), F.struct("p", "n"))).alias("_cells"))
    found = found.withColumn("_labels", F.array_sort(F.collect_list("label").over(Window.partitionBy())))
    met = F.map_from_entries("_cells")
    counts = F.map_from_entries(F.transform("_labels", lambda x: F.struct(x, F.coalesce(F.try_element_at("_met", x), F.lit(0)))))
    return found.withColumn("_met", met).select("label", counts.alias("counts")).orderBy("label")


def label_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per true label: support, tp, fp, predicted, precision, recall, fpr, f1."""
    conf = confusion_counts(pred, label, prediction)
    n = conf.agg(F.sum("count")).scalar()
    per_label = conf.groupBy("label").agg(
        F.sum("count").alias("support"),
        F.coalesce(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count"))), F.lit(0))
        .alias("tp"))
    per_pred = conf.groupBy(F.col("prediction").alias("label")).agg(F.sum("count").alias("predicted"))
    m = per_label.join(per_pred, "label", "left").withColumn(
        "predicted", F.coalesce(F.col("predicted"), F.lit(0)))
    tp, support, predicted = (F.col(c).cast("double") for c in ("tp", "support", "predicted"))
    fp = predicted - tp
    precision = F.when(predicted == 0, F.lit(0.0)).otherwise(tp / predicted)
    recall = tp / support
    fpr = F.try_divide(fp, F.lit(n).cast("double") - support)
    m = m.select("label", "support", "tp", (F.col("predicted") - F.col("tp")).alias("fp"), "predicted",
                 precision.alias("precision"), recall.alias("recall"), F.coalesce(fpr, F.lit(0.0)).alias("fpr"))
    p, r = F.col("precision"), F.col("recall")
    f1 = F.when(p + r == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))
    return m.withColumn("f1", f1)


def summary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: rows, correct, accuracy, weighted recall and the majority-class share.

    Weighted recall = sum(support * recall) / n = sum(tp) / n, computed in
    the second (exact, integer) form; the majority share is the accuracy of
    always predicting the most frequent true label.
    """
    conf = confusion_counts(pred, label, prediction)
    per_label = conf.groupBy("label").agg(
        F.sum("count").alias("support"),
        F.coalesce(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count"))), F.lit(0))
        .alias("tp"))
    s = per_label.agg(F.sum("support").alias("n"), F.sum("tp").alias("correct"),
                      F.max("support").alias("majority_support"))
    n = F.col("n").cast("double")
    return s.select("n", "correct",
                    (F.col("correct").cast("double") / n).alias("accuracy"),
                    (F.col("correct").cast("double") / n).alias("weighted_recall"),
                    (F.col("majority_support").cast("double") / n).alias("majority_share"))


def run_section(coverage: DataFrame, seconds: float, params: dict[str, object],
                malformed: DataFrame | None = None) -> DataFrame:
    """Report rows of a run: total, usable and usable percent, training seconds, the best parameters
    (as text in ``label``, value NULL); with ``malformed`` (one row, see
    :func:`patrolstat.sources.readers.malformed_count`) also the lines read and the malformed ones."""
    def row(section: str, lab, value):
        return F.struct(F.lit(section).alias("section"), F.lit(lab).cast("string").alias("label"),
                        (value if not isinstance(value, (int, float, type(None))) else F.lit(value)).cast("double").alias("value"))
    rows = [row(c, None, F.col(c)) for c in ("total_records", "usable_records", "usable_percent")]
    rows.append(row("training_seconds", None, float(seconds)))
    rows += [row("best_parameter", f"{k}={v}", None) for k, v in sorted(params.items())]
    out = coverage.select(F.inline(F.array(*rows)))
    if malformed is not None:
        out = out.unionByName(malformed.select(F.inline(F.array(*[row(c, None, F.col(c)) for c in malformed.columns]))))
    return out


def evaluation_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Tidy report rows (section, label, value) for a report sink."""
    per = label_metrics(pred, label, prediction)
    parts = [per.select(F.lit(sec).alias("section"), F.col("label").cast("string").alias("label"),
                        F.col(sec).cast("double").alias("value"))
             for sec in ("precision", "recall", "fpr", "f1", "support")]
    summ = summary_metrics(pred, label, prediction)
    parts.append(summ.select(F.lit("accuracy").alias("section"), F.lit(None).cast("string").alias("label"),
                             F.col("accuracy").alias("value")))
    parts.append(summ.select(F.lit("majority_share").alias("section"), F.lit(None).cast("string").alias("label"),
                             F.col("majority_share").alias("value")))
    conf = confusion_counts(pred, label, prediction)
    parts.append(conf.select(F.lit("confusion").alias("section"),
                             F.concat_ws("->", F.col("label").cast("string"), F.col("prediction").cast("string"))
                             .alias("label"), F.col("count").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
