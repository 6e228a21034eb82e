"""The four end-to-end programs, composed from the library's operators.

1. :func:`census_cut`          -- census geography + segment files -> per-zip census records
2. :func:`assign_incident_zips` -- raw incident CSV + zip centroids -> zip-tagged incidents
3. :func:`zip_slot_profile` / :func:`category_breakdown` -- per-zip profile, bucket counts
4. :func:`train_and_evaluate`  -- classifier grid search + evaluation report

Each returns DataFrames (lazy plans); writing them is the caller's choice
(:mod:`patrolstat.sources.sinks`).  Inputs are DataFrames or paths, so the
same code runs over files on a cluster and over stand-ins in tests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrolstat.functions.tables import CENSUS_SEGMENT_COUNT, NO_ZIP
from patrolstat.operators import aggregate as A
from patrolstat.operators import clean as C
from patrolstat.operators import features as FE
from patrolstat.operators import joins as J
from patrolstat.operators import metrics as ME
from patrolstat.operators import models as MO
from patrolstat.operators.nearest import nearest_centroid
from patrolstat.operators.stitch import segment_stitch
from patrolstat.sources import readers as R


def census_cut(geo_lines: DataFrame, segment_lines: DataFrame, zips: DataFrame,
               zip_col: str = "zip", n_segments: int = CENSUS_SEGMENT_COUNT) -> DataFrame:
    """Census records of the given zips: (zip, logrecno, record).

    ``geo_lines``: fixed-width geography lines (``value``); ``segment_lines``:
    ``value`` + ``segment`` (see :func:`readers.read_numbered_segments`);
    ``zips``: the city's zip list.  Geography rows are kept by a semi join on
    the zip list, segment rows by a semi join on the kept record numbers,
    then the N segments are stitched per record number in one aggregation
    and re-keyed to zip.
    """
    geo = R.census_geo_records(geo_lines)
    city_geo = J.semi_join_filter(geo, zips.select(F.col(zip_col).alias("zcta5")), key="zcta5")
    segs = R.census_segment_records(segment_lines)
    city_segs = J.semi_join_filter(segs, city_geo.select("logrecno"), key="logrecno")
    stitched = segment_stitch(city_segs, key="logrecno", segment="segment", payload="payload",
                              n_segments=n_segments)
    keyed = J.rekey_join(stitched, city_geo.select("logrecno", F.col("zcta5").alias("zip")),
                         old_key="logrecno", new_key="zip")
    return keyed.select("zip", "logrecno", "record")


# --- FIXED VALUES: census fields of the profile, as positions counted with the
# record number as field 0; our record starts after it, hence one less there.
CENSUS_FIELDS: dict[str, int] = {
    "total_population": 1,
    "median_household_income": 1237,
    "per_capita_income": 1455,
    "poverty_status_population": 1507,
}
# --- end of fixed values


def census_profile(census_records: DataFrame, fields: dict[str, int] | None = None) -> DataFrame:
    """Pick numbered fields of the stitched census record: {name: index in ``record``, from 0}.

    Default: :data:`CENSUS_FIELDS`.

    Several record numbers may share one zip; the smallest record number is
    kept, deterministically.
    """
    fields = fields if fields is not None else {k: i - 1 for k, i in CENSUS_FIELDS.items()}
    parts = F.split(F.col("record"), ",")
    picked = census_records.select("zip", "logrecno", *[
        F.get(parts, i).try_cast("long").alias(name) for name, i in fields.items()])
    return A.dedup_keep_first(picked, key="zip", order_by="logrecno").drop("logrecno")


def assign_incident_zips(incidents: DataFrame, centroids: DataFrame,
                         lat: str = "latitude", lon: str = "longitude", order: str = "line") -> DataFrame:
    """Tag each incident with the zip of its nearest centroid (``00000`` without coordinates).

    ``centroids`` carries ``zip latitude longitude`` and the place in the file in ``order``
    (see :func:`readers.read_zip_centroids`); it breaks distance ties towards the earlier
    row, as a first-wins scan of the file does.  Without that column ties go to the smallest zip.
    Text coordinates are parsed with ``try_cast``.
    """
    cents = centroids.select("zip", F.col("latitude").cast("double").alias("clat"), F.col("longitude").cast("double").alias("clon"),
                             F.col(order if order in centroids.columns else "zip").alias("ord"))
    pts = incidents.withColumn("_lat", F.col(lat).try_cast("double")) \
        .withColumn("_lon", F.col(lon).try_cast("double"))
    tagged = nearest_centroid(pts, cents, "_lat", "_lon", "clat", "clon", zone="zip", order="ord",
                              out="_zip", distance_col=None, missing_zone=NO_ZIP, max_distance=10000.0)
    tagged = tagged.withColumn("zip", F.coalesce(F.col("_zip"), F.lit("empty")))
    return tagged.drop("_lat", "_lon", "_zip")


def zip_slot_profile(raw_incidents: DataFrame, census: DataFrame, key: str = "zip",
                     order_by: str = "logrecno") -> DataFrame:
    """Per-zip census profile + incident counts, mean severity and thefts per 6-hour slot.

    ``raw_incidents`` are zip-tagged text fields; ``census`` may hold several
    records per zip (the one with the smallest ``order_by`` is kept); without that
    column it has one per zip already, as :func:`census_profile` returns it.
    """
    profile = A.dedup_keep_first(census, key=key, order_by=order_by).drop(order_by) if order_by in census.columns else census
    return A.slot_profile(C.typed_incidents(raw_incidents), profile, key=key)


def category_breakdown(incidents: DataFrame, district: str = "district") -> tuple[DataFrame, DataFrame]:
    """Keyword-bucket counts city-wide and per police district.

    One scan of the incidents: the city's counts are the sums of the districts' (a row per district,
    kept in the checkpoint folder by whichever result is computed first).
    """
    by = A.bucket_counts(incidents, group_by=district).checkpoint(eager=False)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in by.columns if c != district]
    return by.agg(*sums), by


@dataclass
class TrainResult:
    coverage: DataFrame
    cv: MO.CVResult
    predictions: DataFrame
    label_metrics: DataFrame
    summary: DataFrame
    report: DataFrame


def train_and_evaluate(spark: SparkSession, incidents: DataFrame, grid: dict[str, list],
                       folds: int = 3, parallelism: int = 2, train_percent: int = 70,
                       key: str = "incident_id", classifier: str = "random_forest",
                       seed: int = 12345, partitions: int | None = None,
                       malformed: DataFrame | None = None) -> TrainResult:
    """Coverage, key-based split, grid search on weighted recall, evaluation on the test part.

    ``incidents`` are typed incidents (:func:`operators.clean.typed_incidents`).
    The feature stages are fitted on the training part only.  ``partitions`` of the training set
    follow from its bytes unless given; ``malformed`` (:func:`readers.malformed_count`) goes into the report.
    """
    coverage = C.coverage(incidents)
    rows = FE.key_split(MO.training_frame(incidents, keep=[key]), key, train_percent)
    train = rows.filter(F.col("split") == "train").drop("split")
    test = rows.filter(F.col("split") == "test").drop("split")
    est = {"random_forest": lambda: MO.random_forest(seed=seed),
           "decision_tree": lambda: MO.decision_tree(seed=seed),
           "logistic_regression": MO.logistic_regression}[classifier]()
    cv = MO.cross_validate(MO.classification_pipeline(est), est, grid, train, folds=folds,
                           parallelism=parallelism, seed=seed, partitions=partitions)
    preds = MO.predictions(cv.model, test, keep=[key])
    return TrainResult(coverage=coverage, cv=cv, predictions=preds,
                       label_metrics=ME.label_metrics(preds), summary=ME.summary_metrics(preds),
                       report=ME.evaluation_report(preds).unionByName(
                           ME.run_section(coverage, cv.seconds, max(cv.scores, key=lambda s: s[1])[0], malformed)))
