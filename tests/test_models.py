from pyspark.sql import functions as F

from patrolstat.operators import clean as C
from patrolstat.operators import features as FE
from patrolstat.operators import models as MO
from patrolstat.sources.sinks import load_model, save_model

DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
CATS = ["Robbery", "Warrant", "Assault", "Vandalism", "Fraud", "Arson"]


def _incidents(spark, n=400):
    rows = [(i, str(94100 + i % 7), f"2019/{1 + i % 12:02d}/{1 + i % 28:02d}", f"{i % 24:02d}:{i % 60:02d}",
             "2019", DAYS[i % 7], "06374", CATS[(i * 7) % len(CATS)], "A") for i in range(n)]
    raw = spark.createDataFrame(rows, "incident_id long, zip string, incident_date string, incident_time string, "
                                      "incident_year string, day_of_week string, incident_code string, "
                                      "category string, district string")
    return C.typed_incidents(raw)


def test_training_frame_schema(spark):
    t = MO.training_frame(_incidents(spark))
    assert t.columns == list(MO.TRAINING_COLUMNS)
    assert t.filter(F.col("label") == 0).count() == 0


def test_feature_helpers(spark):
    df = spark.createDataFrame([(d,) for d in DAYS[:3] + ["Monday"]], "dow string")
    idx = FE.frequency_index(df, "dow", "i").collect()
    assert {r.dow: r.i for r in idx}["Monday"] == 0.0          # most frequent first
    dummies = FE.weekday_dummies(df, "dow").first()
    assert dummies.Monday == 1 and dummies.Sunday == 0
    split = FE.key_split(spark.range(1000).withColumnRenamed("id", "k"), "k", 70)
    n_train = split.filter(F.col("split") == "train").count()
    assert 600 < n_train < 800
    assert split.collect() == FE.key_split(spark.range(1000).withColumnRenamed("id", "k"), "k", 70).collect()


def test_fit_predict_save_load(spark, scratch):
    t = FE.key_split(MO.training_frame(_incidents(spark), keep=["incident_id"]), "incident_id", 70)
    train, test = t.filter("split = 'train'"), t.filter("split = 'test'")
    model = MO.fit(MO.classification_pipeline(MO.random_forest(num_trees=5, max_depth=3)), train)
    preds = MO.predictions(model, test, keep=["incident_id"])
    assert preds.count() == test.count()
    path = str(scratch / "model")
    save_model(model, path)
    again = MO.predictions(load_model(path), test, keep=["incident_id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, preds.collect()))


def test_cross_validate_and_lr(spark):
    t = MO.training_frame(_incidents(spark))
    rf = MO.random_forest(num_trees=3, max_depth=2)
    res = MO.cross_validate(MO.classification_pipeline(rf), rf, {"maxDepth": [2, 3]}, t, folds=2)
    assert len(res.scores) == 2 and res.seconds > 0
    assert MO.cv_scores_frame(spark, res).count() == 2
    lr = MO.fit(MO.classification_pipeline(MO.logistic_regression(max_iter=10)), t)
    coef = MO.lr_coefficients(spark, lr)
    assert coef.filter("feature_index = -1").count() > 0


def test_one_hot_all_columns_is_narrow(spark):
    t = MO.training_frame(_incidents(spark))
    model = MO.fit(MO.classification_pipeline(MO.decision_tree(max_depth=3), one_hot_all=True), t)
    width = model.transform(t).first().features.size
    distinct = sum(t.select(c).distinct().count() for c in
                   ["dayOfWeek", "zipcode", "month", "date", "hour", "minute", "year"])
    # indexed first: one slot per value seen (+1 for unseen values), never as wide as a raw zip
    assert width == distinct + 7
    assert len(MO.param_grid(MO.random_forest(), MO.FULL_RF_GRID)) == 768


def test_notebook_grid(spark):
    cells = 1
    for values in MO.NOTEBOOK_RF_GRID.values():
        cells *= len(values)
    maps = MO.param_grid(MO.random_forest(), MO.notebook_grid())
    assert cells == 432 and len(maps) == cells // 3
    assert {v for m in maps for p, v in m.items() if p.name == "minInstancesPerNode"} == {1, 2, 5}
    assert {v for m in maps for p, v in m.items() if p.name == "featureSubsetStrategy"} == {"auto", "sqrt", "log2"}


def test_distributed_ranks_equal_the_indexer(spark):
    import pytest

    rows = [(i, None if i % 11 == 0 else f"v{(i * i) % 37}" if i % 3 else "hot") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, v string").repartition(7)
    want = {(r.id, r.v, r.x) for r in FE.frequency_index(df, "v", "x").collect()}
    assert {(r.id, r.v, r.x) for r in FE.frequency_index_distributed(df, "v", "x").collect()} == want
    numbers = df.select("id", (F.col("id") % 12).cast("int").alias("v"))
    assert sorted(map(tuple, FE.frequency_index_distributed(numbers, "v", "x").collect())) == sorted(
        map(tuple, FE.frequency_index(numbers, "v", "x").collect()))
    ranks = FE.frequency_ranks(df, "v")
    new = spark.createDataFrame([("hot",), ("never seen",), (None,)], "v string")
    n = float(ranks.count())
    assert {r.v: r.x for r in FE.apply_ranks(new, ranks, "v", "x").collect()} == {"hot": 0.0, "never seen": n, None: n}
    with pytest.raises(Exception, match="no index for the value of v: never seen"):
        FE.apply_ranks(new.limit(2), ranks, "v", "x", keep_invalid=False).collect()
    assert FE.frequency_index_distributed(df.limit(0), "v", "x").count() == 0


RAW = "incident_id long, zip string, incident_date string, incident_time string, incident_year string, day_of_week string"


def test_a_loaded_model_scores_raw_rows(spark, scratch):
    t = MO.training_frame(_incidents(spark))
    model = MO.fit(MO.classification_pipeline(MO.random_forest(num_trees=5, max_depth=3)), t)
    save_model(MO.raw_scorer(model), str(scratch / "scorer"))
    loaded = load_model(str(scratch / "scorer"))
    raw = spark.createDataFrame([
        (1, "94121", "2019/12/15", "12:00", "2019", "Monday"), (2, "94103", "2019/01/02", "23:59", "2019", "Holiday"),
        (3, "00000", "2019/12/15", "12:00", "2019", "Monday"), (4, "94121", "null", "12:00", "2019", "Monday"),
        (5, None, "2019/12/15", "12:00", "2019", "Monday"), (6, "94121", "2019/12/15", "noon", "2019", "Monday"),
        (7, "94121", "2019/12/15", "12:00", "null", "Monday"), (8, "94121", "2019/12/15", "12:00", "2019", " "),
        (9, "abc", "2019/12/15", "12:00", "2019", "Monday")], RAW)
    got = {r.incident_id: r.prediction for r in MO.score_raw(loaded, raw, keep=["incident_id"]).collect()}
    typed = spark.createDataFrame([(1, 94121, 12, 15, 12, 0, 2019, "Monday"), (2, 94103, 1, 2, 23, 59, 2019, "Holiday")],
                                  "incident_id long, zipcode int, month int, date int, hour int, minute int, year int, dayOfWeek string")
    assert got == {r.incident_id: r.prediction for r in model.transform(typed).collect()}
    clash = raw.withColumn("Hour", F.lit("x")).withColumn("label", F.lit(None).cast("double"))
    assert {r.incident_id: r.prediction for r in MO.score_raw(loaded, clash, keep=["incident_id"]).collect()} == got
    assert MO.score_raw(loaded, raw.limit(0)).count() == 0


def test_a_grid_search_scores_raw_rows(spark):
    t = MO.training_frame(_incidents(spark))
    dt = MO.decision_tree()
    found = MO.cross_validate(MO.classification_pipeline(dt), dt, {"maxDepth": [1, 2]}, t, folds=2)
    raw = spark.createDataFrame([(1, "94101", "2019/12/15", "12:00", "2019", "Monday")], RAW)
    assert MO.score_raw(MO.raw_scorer(found.model), raw).count() == 1


def test_partition_plan(spark):
    t = MO.training_frame(_incidents(spark), keep=["incident_id"])
    n = t.count()
    texts = t.agg(F.sum(F.octet_length("dayOfWeek"))).first()[0]
    assert MO.training_bytes(t) == n * 8 * (len(t.columns) - 1) + texts
    assert MO.partition_plan(t) == MO.MIN_TRAIN_PARTITIONS
    assert MO.partition_plan(t, partition_bytes=100) == -(-MO.training_bytes(t) // 100) > 100
    assert MO.partition_plan(t.limit(0), least=1) == 1
    assert MO.spread(t, 1000).rdd.getNumPartitions() == 1000


def test_what_depends_on_partitions(spark):
    t = MO.training_frame(_incidents(spark))
    rf = MO.random_forest(num_trees=3, max_depth=3)
    same = [MO.fit(MO.classification_pipeline(rf), x, partitions=5).stages[-1].toDebugString.split("\n", 1)[1]
            for x in (t, t.repartition(3), t.coalesce(1))]
    assert same[0] == same[1] == same[2]
    dt = MO.decision_tree()
    scores = [MO.cross_validate(MO.classification_pipeline(dt), dt, {"maxDepth": [2]}, t, folds=3, partitions=p).scores for p in (2, 9)]
    assert scores[0][0][1] == scores[1][0][1]      # trees see all rows, so equal folds give equal scores


def test_folds_by_a_column(spark):
    t = MO.training_frame(_incidents(spark), keep=["incident_id"])
    dt = MO.decision_tree()
    found = MO.cross_validate(MO.classification_pipeline(dt), dt, {"maxDepth": [1]}, t, folds=2, fold=F.col("incident_id") % 2)
    assert len(found.scores) == 1
