from patrolstat.plans import programs as PR

RAW = "incident_id long, zip string, incident_date string, incident_time string, incident_year string, " \
      "day_of_week string, incident_code string, category string, district string"
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
CATS = ["Robbery", "Warrant", "Assault", "Vandalism", "Fraud", "Arson", "Traffic Collision"]


def _raw(spark, n=300):
    rows = [(i, str(94100 + i % 5), f"2019/{1 + i % 12:02d}/{1 + i % 28:02d}", f"{i % 24:02d}:{i % 60:02d}",
             "2019", DAYS[i % 7], "06374", CATS[(i * 3) % len(CATS)], f"D{i % 4}") for i in range(n)]
    return spark.createDataFrame(rows, RAW)


def test_zip_slot_profile_dedups_census(spark):
    census = spark.createDataFrame([("94100", "0000002", 5), ("94100", "0000001", 7), ("94101", "0000003", 9)],
                                   "zip string, logrecno string, population int")
    out = {r.zip: r for r in PR.zip_slot_profile(_raw(spark), census).collect()}
    assert set(out) == {"94100", "94101"}
    assert out["94100"].population == 7                       # smallest record number kept
    assert out["94100"].total_count == 60


def test_category_breakdown(spark):
    from patrolstat.operators.clean import typed_incidents

    from patrolstat.operators.aggregate import bucket_counts

    inc = typed_incidents(_raw(spark))
    total, by = PR.category_breakdown(inc)
    t = total.first()
    assert t.total_incidents == 300 and t == bucket_counts(inc).first()
    assert PR.category_breakdown(inc.limit(0))[0].first() == bucket_counts(inc.limit(0)).first()
    assert sum(r.total_incidents for r in by.collect()) == 300


def test_train_and_evaluate(spark):
    from patrolstat.operators.clean import typed_incidents

    res = PR.train_and_evaluate(spark, typed_incidents(_raw(spark)), grid={"maxDepth": [2, 3], "numTrees": [3]},
                                folds=2)
    assert len(res.cv.scores) == 2
    s = res.summary.first()
    assert 0.0 <= s.accuracy <= 1.0 and s.n == res.predictions.count()
    assert res.coverage.first().total_records == 300
    assert {r.section for r in res.report.collect()} >= {"accuracy", "precision"}


def test_census_chain_from_text_to_profile_text(spark):
    from patrolstat.operators.render import render_profile

    geo = spark.createDataFrame([(" " * 18 + f"000000{i}" + " " * 135 + z,) for i, z in ((1, "94100"), (2, "94100"), (3, "94101"))],
                                "value string")
    # two segments that hold 1,600 fields together; field k of the record (from 0) is 10000 * i + k
    segs = spark.createDataFrame([("X" * 15 + f"000000{i} " + ",".join(str(10000 * i + k) for k in span), s)
                                  for i in (1, 2, 3) for s, span in ((1, range(900)), (2, range(900, 1600)))], "value string, segment int")
    records = PR.census_cut(geo, segs, spark.createDataFrame([("94100",), ("94101",)], "zip string"), n_segments=2)
    profile = PR.zip_slot_profile(_raw(spark), PR.census_profile(records))
    rows = {r.zip: r for r in profile.collect()}
    assert [rows["94100"][c] for c in PR.CENSUS_FIELDS] == [10000 + i - 1 for i in PR.CENSUS_FIELDS.values()]
    text = {r.zip: r.profile_text for r in render_profile(profile, "zip", [("Total Population", "total_population")]).collect()}
    assert text["94101"].startswith("(94101,(censusData: {Total Population: 30000},totalIncidentCount: 60----")


def test_report_has_the_run(spark):
    from patrolstat.operators.clean import typed_incidents

    res = PR.train_and_evaluate(spark, typed_incidents(_raw(spark)), grid={"maxDepth": [2], "numTrees": [2]}, folds=2)
    got = {r.section: r for r in res.report.collect()}
    assert "malformed_lines" not in got
    counted = spark.createDataFrame([(305, 5)], "total_lines long, malformed_lines long")
    more = PR.train_and_evaluate(spark, typed_incidents(_raw(spark)), grid={"maxDepth": [2], "numTrees": [2]}, folds=2, partitions=3,
                                 malformed=counted)
    assert {r.section: r.value for r in more.report.collect() if r.section.endswith("_lines")} == {"total_lines": 305, "malformed_lines": 5}
    assert got["total_records"].value == 300 and got["training_seconds"].value > 0
    assert got["best_parameter"].label in ("maxDepth=2", "numTrees=2")


def test_a_learnable_label_is_learned(spark):
    from patrolstat.operators import models as MO

    rows = [(94100 + i % 5, 1 + i % 12, 1 + i % 28, i % 24, i % 60, 2019, DAYS[i % 7], 1.0 + (i % 24) // 6) for i in range(800)]
    df = spark.createDataFrame(rows, "zipcode int, month int, date int, hour int, minute int, year int, dayOfWeek string, label double")
    model = MO.fit(MO.classification_pipeline(MO.random_forest(max_depth=8)), df)
    got = {r.part: r.accuracy for r in MO.train_and_test_accuracy(model, df, df.limit(200)).collect()}
    assert got["train"] >= 0.95 and got["test"] >= 0.95
