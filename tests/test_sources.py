import pytest
from pyspark.sql import functions as F

from patrolstat.sources import readers as R
from patrolstat.sources import sinks as K
from patrolstat.sources.lines import in_file_order, with_line_numbers

HEADER = ",".join(f'"{c}"' if "," in c else c for c in R.INCIDENT_CSV_COLUMNS)


def _incident_line(date, time, category, district, lat, lon):
    fields = [""] * len(R.INCIDENT_CSV_COLUMNS)
    idx = {c: i for i, c in enumerate(R.INCIDENT_CSV_COLUMNS)}
    fields[idx["Incident Date"]] = date
    fields[idx["Incident Time"]] = time
    fields[idx["Incident Year"]] = date[:4]
    fields[idx["Incident Day of Week"]] = "Thursday"
    fields[idx["Incident ID"]] = "854240"
    fields[idx["Incident Code"]] = "06374"
    fields[idx["Incident Category"]] = f'"{category}"' if "," in category else category
    fields[idx["Police District"]] = district
    fields[idx["Latitude"]] = lat
    fields[idx["Longitude"]] = lon
    return ",".join(fields)


def test_incident_csv_quotes_and_empty_fields(spark, scratch):
    p = scratch / "incidents.csv"
    p.write_text("\n".join([
        HEADER,
        _incident_line("2019/08/15", "11:41", "Human Trafficking (A), Commercial Sex Acts", "Central", "", ""),
        _incident_line("2019/10/04", "14:25", "Robbery", "Richmond", "37.775", "-122.511"),
    ]) + "\n")
    df = R.read_incident_csv(spark, str(p))
    rows = df.orderBy("incident_date").collect()
    assert len(rows) == 2                      # header is not a row
    assert rows[0].category == "Human Trafficking (A), Commercial Sex Acts"
    assert rows[0].latitude is None            # empty field -> NULL
    assert rows[1].latitude == "37.775" and rows[1].district == "Richmond"


def test_zip_centroids_semicolon(spark, scratch):
    p = scratch / "zips.csv"
    p.write_text(";".join(R.ZIP_CENTROID_COLUMNS) + "\n"
                 "94175;San Francisco;CA;37.784827;-122.727802;-8;1;37.784827,-122.727802\n"
                 "00501;Holtsville;NY;40.81;-73.04;-5;1;40.81,-73.04\n")
    df = R.read_zip_centroids(spark, str(p))
    rows = df.collect()
    assert [r.zip for r in rows] == ["94175", "00501"]    # zip stays text, leading zeros kept
    assert rows[0].latitude == 37.784827


def test_malformed_rows_are_kept_apart(spark, scratch):
    good = _incident_line("2019/08/15", "11:41", 'Human Trafficking (A), Commercial Sex Acts', "Central", "37.7", "-122.4")
    long_, short = good + ",extra,fields", ",".join(good.split(",")[:9])
    unclosed = good.replace(",Central,", ',"Central,')
    (scratch / "i.csv").write_text("\n".join([HEADER, good, short, long_, unclosed, good]) + "\n")
    rows = R.read_incident_csv(spark, str(scratch / "i.csv"), corrupt_column="bad")
    ok, quarantine = R.split_malformed(rows, "bad")
    assert [r.district for r in ok.collect()] == ["Central", "Central"] and "bad" not in ok.columns
    assert [r.bad for r in quarantine.select("bad").collect()] == [short, long_, unclosed]
    assert quarantine.filter("incident_time = '11:41'").count() == 3      # what could be read is there
    assert ok.select("district").count() == 2                             # whatever columns are read
    assert R.malformed_count(rows, "bad").first() == (5, 3)

    head = ";".join(R.ZIP_CENTROID_COLUMNS)
    (scratch / "z.csv").write_text(f"{head}\n94175;SF;CA;37.7;-122.7;-8;1;x\n94176;SF;CA\n94177;SF;CA;north;-122.7;-8;1;x\n")
    ok, quarantine = R.split_malformed(R.read_zip_centroids(spark, str(scratch / "z.csv"), R.CORRUPT))
    assert [(r.zip, r.line) for r in ok.collect()] == [("94175", 0)]
    assert [(r.zip, r.line) for r in quarantine.orderBy("line").collect()] == [("94176", 1), ("94177", 2)]


@pytest.fixture()
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("materialize", [True, False])
def test_line_numbers_at_any_split_size(spark, scratch, tiny_splits, materialize):
    (scratch / "d").mkdir()
    want = []
    for name, n in (("a.txt", 400), ("b.txt", 0), ("c.txt", 7), ("d.txt", 1000)):
        lines = [f"{name} line {i} " + "x" * (i % 50) for i in range(n)]
        (scratch / "d" / name).write_text("".join(x + "\n" for x in lines))
        want += [(x, i, name) for i, x in enumerate(lines)]
    rows = spark.read.text(str(scratch / "d"))
    assert rows.rdd.getNumPartitions() > 20
    got = with_line_numbers(rows, materialize=materialize).orderBy("line").collect()
    assert [(r.value, r.line) for r in got] == [(x, i) for i, (x, _, _) in enumerate(want)]
    per_file = with_line_numbers(rows, "n", file="path", materialize=materialize).collect()
    assert sorted((r.value, r.n, r.path.rsplit("/", 1)[1]) for r in per_file) == sorted(want)
    assert [r.value for r in in_file_order(rows, materialize=materialize).collect()] == [x for x, _, _ in want]
    assert with_line_numbers(spark.read.text(str(scratch / "d" / "b.txt"))).count() == 0


def test_ties_go_to_the_first_centroid_of_the_file(spark, scratch, tiny_splits):
    from patrolstat.plans import programs as PR

    rows = [f"{zip_};SF;CA;{37 + zip_ % 10};-122.0;-8;1;geo" for zip_ in range(94999, 94100, -1)]
    (scratch / "z.csv").write_text("\n".join([";".join(R.ZIP_CENTROID_COLUMNS), *rows]) + "\n")
    cents = R.read_zip_centroids(spark, str(scratch / "z.csv"))
    assert spark.read.text(str(scratch / "z.csv")).rdd.getNumPartitions() > 20
    inc = spark.createDataFrame([(str(i), str(37 + i), "-122.0") for i in range(10)], "incident_id string, latitude string, longitude string")
    got = {int(r.incident_id): r.zip for r in PR.assign_incident_zips(inc, cents).collect()}
    assert got == {i: str(max(z for z in range(94101, 95000) if z % 10 == i)) for i in range(10)}


def test_headerless_and_shared_header(spark, scratch):
    a, b = scratch / "a.csv", scratch / "b.csv"
    a.write_text("x,y\n1,2\n3,4\n")
    b.write_text("5,6\n")
    df = R.read_pair_shared_header(spark, str(a), str(b))
    assert df.columns == ["x", "y"]
    assert sorted(r.x for r in df.collect()) == ["1", "3", "5"]
    h = R.read_headerless(spark, str(b), ["_c0", "_c1"])
    assert h.first()._c1 == "6"


def test_lines_and_tagged_lines(spark, scratch):
    p = scratch / "tagged.txt"
    p.write_text('(94112,2019/06/13,20:00,"Theft, Other",Ingleside)\n(00000,2019/08/15,11:41,Robbery,Central)\n')
    lines = R.read_lines(spark, str(p), min_partitions=2)
    df = R.parse_tagged_lines(lines, ["date", "time", "category", "district"])
    rows = sorted(df.collect(), key=lambda r: r.zip)
    assert rows[1].zip == "94112" and rows[1].category == "Theft, Other"
    assert rows[0].district == "Central"


def test_numbered_segments_and_census_records(spark, scratch):
    d = scratch / "seg"
    d.mkdir()
    for i in (1, 2, 10):
        (d / f"ca{i:05d}.uf3").write_text(f"{'X' * 15}0000001 payload{i}\n")
    segs = R.read_numbered_segments(spark, str(d / "*.uf3"))
    recs = R.census_segment_records(segs).collect()
    assert sorted((r.segment, r.logrecno, r.payload) for r in recs) == [
        (1, "0000001", "payload1"), (2, "0000001", "payload2"), (10, "0000001", "payload10")]
    geo = spark.createDataFrame([(" " * 18 + "0000001" + " " * 135 + "94102",)], "value string")
    g = R.census_geo_records(geo).first()
    assert (g.logrecno, g.zcta5) == ("0000001", "94102")


def test_sinks_round_trip(spark, scratch):
    df = spark.createDataFrame([("94102", 3), ("94103", 4)], "zip string, n int")
    K.write_parquet(df, str(scratch / "pq"))
    back = spark.read.parquet(str(scratch / "pq"))
    assert sorted(map(tuple, back.collect())) == [("94102", 3), ("94103", 4)]
    K.write_text(df, str(scratch / "txt"), F.concat_ws(":", "zip", "n"))
    assert sorted(r.value for r in spark.read.text(str(scratch / "txt")).collect()) == ["94102:3", "94103:4"]
    rep = spark.createDataFrame([("accuracy", None, 0.5)], "section string, label string, value double")
    K.write_report(rep, str(scratch / "rep"))
    assert spark.read.option("header", True).csv(str(scratch / "rep")).first().section == "accuracy"
    assert K.preview(df, 1).count() == 1
