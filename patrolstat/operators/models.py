"""Severity classifiers: training frame, pipelines, grid search, scoring.

Spark ML fits the models; this module only composes it.  The feature
stages are fitted on the training rows only, the training set is persisted
(memory and disk, recomputable from lineage if an executor is lost) before
cross-validation re-reads it fold after fold, and trees checkpoint their
node ids into the session's checkpoint folder.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patrolstat.operators.clean import usable_condition
from patrolstat.operators.features import feature_stages, indexed_one_hot_stages

TRAINING_COLUMNS = ("zipcode", "month", "date", "hour", "minute", "year", "dayOfWeek", "label")

# --- FIXED VALUES: the reference's full random-forest search grid (768 cells)
FULL_RF_GRID: dict[str, list] = {
    "numTrees": [5, 10, 20, 30, 40, 50],
    "impurity": ["entropy", "gini"],
    "maxDepth": [2, 3, 5, 8],
    "minInstancesPerNode": [5, 10, 15, 20],
    "maxBins": [5, 10, 20, 30],
}
# --- FIXED VALUES: the notebook's random-forest search grid (432 cells, scikit-learn's names)
NOTEBOOK_RF_GRID: dict[str, list] = {
    "n_estimators": [5, 10, 20, 50],
    "max_features": ["auto", "sqrt", "log2"],
    "criterion": ["gini", "entropy"],
    "max_depth": [5, 10],
    "min_samples_split": [2, 5, 10],
    "max_leaf_nodes": [50, 60, 70],
}
# --- end of fixed values


def notebook_grid(grid: dict[str, list] = NOTEBOOK_RF_GRID) -> dict[str, list]:
    """A scikit-learn forest grid as Spark parameters, for ``param_grid`` and ``cross_validate``.

    ``max_features`` is ``featureSubsetStrategy`` (``auto`` is the square root in both).  A node that
    may be split from ``n`` rows on has children of half of that, roughly: ``minInstancesPerNode`` is
    ``n // 2``.  Spark grows no tree by its number of leaves: ``max_leaf_nodes`` has no counterpart and
    its cells fall together (no tree of depth 5 reaches its smallest value).
    """
    names = {"n_estimators": "numTrees", "max_features": "featureSubsetStrategy", "criterion": "impurity",
             "max_depth": "maxDepth", "min_samples_split": "minInstancesPerNode"}
    return {spark: [v // 2 for v in grid[name]] if name == "min_samples_split" else list(grid[name])
            for name, spark in names.items() if name in grid}


def training_frame(incidents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed incidents -> the classifier's rows (complete rows only, label = weight)."""
    keep = keep or []
    usable = incidents.filter(usable_condition())
    return usable.select(
        *keep,
        F.col("zip").try_cast("int").alias("zipcode"),
        F.col("month").cast("int").alias("month"),
        F.col("day").cast("int").alias("date"),
        F.col("hour").cast("int").alias("hour"),
        F.col("minute").cast("int").alias("minute"),
        F.col("year").cast("int").alias("year"),
        F.col("day_of_week").alias("dayOfWeek"),
        F.col("weight").cast("int").alias("label"),
    ).dropna(subset=["zipcode", "month", "date", "hour", "minute"])


def random_forest(num_trees: int = 20, impurity: str = "gini", max_depth: int = 5,
                  min_instances_per_node: int = 1, max_bins: int = 32, seed: int = 12345,
                  checkpoint_interval: int = 10) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=num_trees, impurity=impurity, maxDepth=max_depth,
                                  minInstancesPerNode=min_instances_per_node, maxBins=max_bins,
                                  seed=seed, cacheNodeIds=True, checkpointInterval=checkpoint_interval)


def decision_tree(impurity: str = "gini", max_depth: int = 5, min_instances_per_node: int = 1,
                  max_bins: int = 32, seed: int = 12345) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(impurity=impurity, maxDepth=max_depth,
                                  minInstancesPerNode=min_instances_per_node, maxBins=max_bins, seed=seed,
                                  cacheNodeIds=True, checkpointInterval=10)


def logistic_regression(max_iter: int = 100, reg_param: float = 0.0) -> LogisticRegression:
    return LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg_param)


def classification_pipeline(classifier, one_hot_all: bool = False, include_code: bool = False) -> Pipeline:
    """Weekday index + one-hot + assembly, then the classifier.

    ``one_hot_all`` one-hot encodes every feature column (each indexed
    first) instead of passing the numeric columns through; ``include_code``
    adds the incident code, the eighth column, which tells the label (leakage).
    """
    if one_hot_all:
        cols = ["dayOfWeek", "zipcode", "month", "date", "hour", "minute", "year"] + ["code"] * include_code
        return Pipeline(stages=[*indexed_one_hot_stages(cols), classifier])
    return Pipeline(stages=[*feature_stages(), classifier])


# Partitions of a training set: by its counted bytes, at least so many, so that what depends on the
# partitioning (bagging) follows from the rows and not from the cores.
MIN_TRAIN_PARTITIONS = 8
TRAIN_PARTITION_BYTES = 8 << 20
FOLD = "_fold"


def training_bytes(train: DataFrame) -> int:
    """Bytes of the training set's values: 8 per fixed-width field, the bytes of texts (one scan)."""
    texts = [c for c, t in train.dtypes if t in ("string", "binary")]
    width = 8 * (len(train.columns) - len(texts))
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts]
    per_row = reduce(lambda a, b: a + b, sizes, F.lit(width).cast("long"))
    return train.agg(F.sum(per_row)).first()[0] or 0


def partition_plan(train: DataFrame, partition_bytes: int = TRAIN_PARTITION_BYTES, least: int = MIN_TRAIN_PARTITIONS) -> int:
    """How many partitions a training set is dealt to: one per ``partition_bytes``, ``least`` at least."""
    return max(least, -(-training_bytes(train) // partition_bytes))


def spread(train: DataFrame, partitions: int | None = None) -> DataFrame:
    """The training set in a fixed partitioning and order, by a hash of its rows.

    Tree and gradient fits pass over it many times; one shuffle up front lets
    every pass use all cores.  Without ``partitions`` :func:`partition_plan` counts.
    """
    h = F.xxhash64(*[F.col(c) for c in train.columns])
    return train.repartition(partitions or partition_plan(train), h).sortWithinPartitions(h)


def fit(pipeline: Pipeline, train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """Fit on a persisted training set; the cache is released afterwards."""
    cached = spread(train, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(cached)
    finally:
        cached.unpersist()


def param_grid(estimator, grid: dict[str, list]) -> list:
    """ParamGridBuilder from {param name: values} on ``estimator``."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), values)
    return b.build()


@dataclass
class CVResult:
    model: object
    seconds: float
    scores: list[tuple[dict, float]]


def cross_validate(pipeline: Pipeline, estimator, grid: dict[str, list], train: DataFrame,
                   folds: int = 3, parallelism: int = 2, metric: str = "weightedRecall",
                   seed: int = 12345, partitions: int | None = None, fold: Column | None = None) -> CVResult:
    """k-fold grid search on ``metric``; returns the refitted best model and timing.

    ``fold`` (an int column, 0 to ``folds`` - 1) names each row's fold; by default it follows from
    a hash of the row's values.  Folds do not depend on ``partitions``.
    """
    maps = param_grid(estimator, grid)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=maps,
                        evaluator=MulticlassClassificationEvaluator(metricName=metric),
                        numFolds=folds, parallelism=parallelism, seed=seed, foldCol=FOLD)
    by_value = F.pmod(F.xxhash64(*[F.col(c) for c in train.columns], F.lit(seed)), F.lit(folds))
    train = train.withColumn(FOLD, (by_value if fold is None else fold).cast("int"))
    cached = spread(train, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        t0 = time.perf_counter()
        model = cv.fit(cached)
        secs = time.perf_counter() - t0
    finally:
        cached.unpersist()
    scores = [({p.name: v for p, v in m.items()}, float(s)) for m, s in zip(maps, model.avgMetrics)]
    return CVResult(model=model, seconds=secs, scores=scores)


def cv_scores_frame(spark: SparkSession, result: CVResult) -> DataFrame:
    """Grid cells and their mean cross-validated metric as a DataFrame."""
    rows = [(", ".join(f"{k}={v}" for k, v in sorted(p.items())), s) for p, s in result.scores]
    return spark.createDataFrame(rows, "params string, avg_metric double")


def predictions(model, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Score rows with the same preprocessing the model was trained with."""
    keep = keep or []
    return model.transform(df).select(*keep, F.col("label").cast("double").alias("label"),
                                      F.col("prediction").cast("double").alias("prediction"))


# --- scoring raw rows: the preprocessing as stages of the saved pipeline ---------------------------------

def raw_stages() -> list[SQLTransformer]:
    """Stages from raw text rows (``zip incident_date incident_time incident_year day_of_week``, ``'null'``
    markers) to the columns the feature stages read; rows that lack one of them, or a zip, are left out.
    """
    def cut(column: str, start: int) -> str:
        return f"try_cast(substring({column}, {start}, 2) AS INT)"

    derived = {
        "zipcode": "try_cast(zip AS INT)", "month": cut("incident_date", 6), "date": cut("incident_date", 9),
        "hour": cut("incident_time", 1), "minute": cut("incident_time", 4), "year": "try_cast(incident_year AS INT)",
        "dayOfWeek": "CASE WHEN trim(day_of_week) NOT IN ('', 'null') THEN day_of_week END",
    }
    typed = ", ".join(f"{sql} AS {name}" for name, sql in derived.items())
    complete = " AND ".join(["zipcode <> 0", *(f"{name} IS NOT NULL" for name in derived)])
    return [SQLTransformer(statement=f"SELECT *, {typed} FROM __THIS__"),
            SQLTransformer(statement=f"SELECT * FROM __THIS__ WHERE {complete}")]


def raw_scorer(model) -> PipelineModel:
    """A fitted pipeline (or the best one of a grid search) with :func:`raw_stages` in front.

    Training runs on typed rows; what is saved takes raw text rows, so a loaded model needs no code of
    the caller to score new ones.
    """
    fitted = getattr(model, "bestModel", model)
    return PipelineModel([*raw_stages(), *fitted.stages])


def score_raw(scorer: PipelineModel, raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Predictions of a :func:`raw_scorer` for raw text rows, labelled or not: ``keep`` columns and ``prediction``."""
    names = {f.lower() for f in ("zipcode", "month", "date", "hour", "minute", "year", "dayOfWeek")}
    clash = [c for c in raw.columns if c.lower() in names]
    return scorer.transform(raw.drop(*clash)).select(*(keep or []), F.col("prediction").cast("double").alias("prediction"))


def train_and_test_accuracy(model, train: DataFrame, test: DataFrame) -> DataFrame:
    """Accuracy of a fitted model on both parts: ``part, accuracy``."""
    def part(name: str, df: DataFrame) -> DataFrame:
        return predictions(model, df).agg(F.lit(name).alias("part"), F.avg((F.col("label") == F.col("prediction")).cast("double"))
                                          .alias("accuracy"))
    return part("train", train).unionByName(part("test", test))


def lr_coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Coefficient matrix and intercepts of a fitted multinomial LR stage (long form)."""
    lr = model.stages[-1]
    mat = lr.coefficientMatrix.toArray()
    rows = [(int(i), int(j), float(mat[i][j])) for i in range(mat.shape[0]) for j in range(mat.shape[1])]
    rows += [(int(i), -1, float(v)) for i, v in enumerate(lr.interceptVector.toArray())]
    return spark.createDataFrame(rows, "class_index int, feature_index int, coefficient double")
