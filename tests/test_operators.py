import random

import pytest
from pyspark.sql import functions as F

from patrolstat.operators import aggregate as A
from patrolstat.operators import clean as C
from patrolstat.operators import joins as J
from patrolstat.operators.nearest import nearest_centroid
from patrolstat.operators.stitch import segment_stitch
from patrolstat.plans import programs as PR


def test_dedup_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([("94102", "0116038", "b"), ("94102", "0116037", "z"),
                                ("94102", "0116037", "a"), ("94103", "0200000", "c")],
                               "zip string, lrn string, payload string")
    out = sorted(map(tuple, A.dedup_keep_first(df, "zip", "lrn").collect()))
    assert out == [("94102", "0116037", "a"), ("94103", "0200000", "c")]


RAW_COLS = "incident_id long, zip string, incident_date string, incident_time string, incident_year string, " \
           "day_of_week string, incident_code string, category string, district string"


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_COLS)


def test_slot_profile_hand_fixture(spark):
    raw = _raw(spark, [
        (1, "94102", "2019/01/01", "01:00", "2019", "Tuesday", "1", "Robbery", "A"),          # slot1 w14 theft
        (2, "94102", "2019/01/01", "05:59", "2019", "Tuesday", "1", "Warrant", "A"),          # slot1 w2
        (3, "94102", "2019/01/01", "18:30", "2019", "Tuesday", "1", "Malicious Mischief", "B"),  # slot4 w14
        (4, "94102", "2019/01/01", "null", "2019", "Tuesday", "1", "Robbery", "B"),           # no slot
        (5, "94103", "2019/01/01", "12:00", "2019", "Tuesday", "1", "Unknown Thing", "B"),    # slot3 w0
        (6, "99999", "2019/01/01", "12:00", "2019", "Tuesday", "1", "Robbery", "B"),          # no profile
        (7, "00000", "2019/01/01", "12:00", "2019", "Tuesday", "1", "Robbery", "B"),          # unassigned
    ])
    profile = spark.createDataFrame([("94102", 29059), ("94103", 100), ("94104", 5)], "zip string, pop int")
    out = {r.zip: r for r in A.slot_profile(C.typed_incidents(raw), profile, "zip").collect()}
    assert set(out) == {"94102", "94103"}
    a = out["94102"]
    assert (a.total_count, a.slot1_count, a.slot1_theft_count, a.slot1_mean_weight) == (3, 2, 1, 8.0)
    assert (a.slot2_count, a.slot2_mean_weight) == (0, None)      # empty slot -> NULL, not NaN
    assert (a.slot4_count, a.slot4_mean_weight, a.slot4_theft_count) == (1, 14.0, 0)
    assert a.pop == 29059
    b = out["94103"]
    assert (b.total_count, b.slot3_count, b.slot3_mean_weight) == (1, 1, 0.0)   # weight 0 still averaged
    for r in out.values():
        assert r.total_count == sum(r[f"slot{i}_count"] for i in range(1, 5))


def test_bucket_counts_invariants(spark):
    cats = ["Robbery", "Traffic Collision", "Drug Offense", "Weapons Offense", "Rape", "Assault",
            "Other Offenses", "Fire Report", "Non-Criminal", "Human Trafficking, Commercial Sex Acts"]
    rows = [(i, "94102", "2019/01/01", "10:00", "2019", "Monday", "1", cats[i % len(cats)], f"D{i % 3}")
            for i in range(60)]
    inc = C.typed_incidents(_raw(spark, rows))
    total = A.bucket_counts(inc).first()
    names = [c for c in total.asDict() if c.endswith("_incidents") and c != "total_incidents"]
    assert sum(total[c] for c in names) == total.total_incidents == 60
    by = A.bucket_counts(inc, group_by="district").collect()
    for c in names + ["total_incidents"]:
        assert sum(r[c] for r in by) == total[c]
    shares = A.bucket_shares(A.bucket_counts(inc)).collect()
    assert abs(sum(s.share for s in shares) - 1.0) < 1e-12


def test_bucket_records(spark):
    from patrolstat.operators.render import render_buckets

    df = spark.createDataFrame([("Robbery", "D1"), ("Fire Report", "D1"), ("Traffic Collision", "D2")], "category string, d string")
    rest = "; Drug/Liquor Incidents: 0; Incidents Involving Weapons: 0; Sexual Incidents: 0; Violent Incidents/Suicide: 0; Incidents Involving Offenses: 0"
    assert render_buckets(A.bucket_counts(df)).first()[0] == (
        f"Total Incidents: 3; Vehicle Incidents: 1; Theft Incidents: 1{rest}; Reporting Incidents: 1; Other Incidents: 0")
    by = {r.d: r.bucket_text for r in render_buckets(A.bucket_counts(df, group_by="d"), "d").collect()}
    assert by["D2"] == f"Total Incidents: 1; Vehicle Incidents: 1; Theft Incidents: 0{rest}; Reporting Incidents: 0; Other Incidents: 0"


def test_distinct_first_seen_and_union(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "b"), (5, "c"), (4, "a")], "ln int, v string")
    out = [tuple(r) for r in A.distinct_first_seen(df, "v", "ln").collect()]
    assert out == [("a", 1), ("b", 2), ("c", 5)]
    u = A.union_sources(df, df.select("v", "ln"))
    assert u.count() == 10 and u.columns == ["ln", "v"]


def test_completeness_and_coverage(spark):
    raw = _raw(spark, [
        (1, "94102", "2019/01/01", "10:00", "2019", "Monday", "06374", "Robbery", "A"),
        (2, "00000", "2019/01/01", "10:00", "2019", "Monday", "06374", "Robbery", "A"),
        (3, "94102", "null", "10:00", "2019", "Monday", "06374", "Robbery", "A"),
        (4, "94102", "2019/01/01", "10:00", "2019", "Monday", "06374", "Unknown", "A"),  # weight 0
        (5, "94102", "2019/01/01", "10:00", "2019", "null", "06374", "Robbery", "A"),
    ])
    inc = C.typed_incidents(raw)
    assert [r.incident_id for r in C.completeness_filter(inc).collect()] == [1]
    cov = C.coverage(inc).first()
    assert (cov.total_records, cov.usable_records, cov.usable_percent_text) == (5, 1, "20.00%")


def test_header_rows_dropped(spark):
    df = spark.createDataFrame([("Zip;C",), ("94102;x",)], "value string")
    assert [r.value for r in C.drop_header_rows(df, {"value": "Zip;C"}).collect()] == ["94102;x"]


def test_joins(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    prof = spark.createDataFrame([(1, "P1"), (2, "P2")], "k int, p string")
    assert sorted(r.v for r in J.enrich_join(prof, facts, "k").collect()) == ["a", "b"]
    assert sorted(r.v for r in J.semi_join_filter(facts, prof, "k").collect()) == ["a", "b"]
    rk = J.rekey_join(facts, prof, "k", "p").collect()
    assert sorted((r.p, r.v) for r in rk) == [("P1", "a"), ("P2", "b")]


def test_segment_stitch(spark):
    rows = [("r1", 2, "b"), ("r1", 1, "a"), ("r1", 3, "c"),
            ("r2", 1, "x"), ("r2", 3, "z"),                     # segment 2 missing -> dropped
            ("r3", 1, "m"), ("r3", 2, None), ("r3", 3, "o"), ("r3", 4, "-")]
    df = spark.createDataFrame(rows, "key string, seg int, payload string")
    out = {r.key: r.record for r in segment_stitch(df, "key", "seg", "payload", 3).collect()}
    assert out == {"r1": "a,b,c,", "r3": "m,,o,"}
    again = df.union(spark.createDataFrame([("r1", 2, "bb")], df.schema))
    with pytest.raises(Exception, match="segment 2 is repeated for record r1"):
        segment_stitch(again, "key", "seg", "payload", 3).collect()


def test_census_cut_program(spark):
    geo = spark.createDataFrame([(" " * 18 + "0000001" + " " * 135 + "94102",),
                                 (" " * 18 + "0000002" + " " * 135 + "10001",)], "value string")
    segs = spark.createDataFrame([("X" * 15 + "0000001 p1", 1), ("X" * 15 + "0000001 p2", 2),
                                  ("X" * 15 + "0000002 q1", 1), ("X" * 15 + "0000002 q2", 2)],
                                 "value string, segment int")
    zips = spark.createDataFrame([("94102",)], "zip string")
    out = PR.census_cut(geo, segs, zips, n_segments=2).collect()
    assert [(r.zip, r.logrecno, r.record) for r in out] == [("94102", "0000001", "p1,p2,")]


def _brute(points, cents):
    out = {}
    for pid, x, y in points:
        if x is None or y is None:
            out[pid] = "00000"
            continue
        best = min(((cx - x) ** 2 + (cy - y) ** 2, o, z) for z, o, cx, cy in cents)
        out[pid] = best[2]
    return out


@pytest.mark.parametrize("tile,top,max_packed", [(32, 256, 1024), (32, 256, 10), (2, 3, 0), (1, 1, 0)])
def test_nearest_centroid_matches_brute_force(spark, tile, top, max_packed):
    rnd = random.Random(7)
    cents = [(f"Z{i:03d}", i, rnd.uniform(37.6, 37.9), rnd.uniform(-122.6, -122.3)) for i in range(40)]
    cents.append(("DUP", 99, cents[3][2], cents[3][3]))        # same spot as Z003, later in file -> loses
    points = [(i, rnd.uniform(37.5, 38.0), rnd.uniform(-122.7, -122.2)) for i in range(300)]
    points += [(1000, None, -122.4), (1001, cents[3][2], cents[3][3]), (1002, 45.0, -100.0)]
    pdf = spark.createDataFrame(points, "pid long, x double, y double")
    cdf = spark.createDataFrame(cents, "zone string, ord long, cx double, cy double")
    got = nearest_centroid(pdf, cdf, "x", "y", "cx", "cy", zone="zone", order="ord", missing_zone="00000",
                           point_id="pid", tile=tile, top=top, max_packed=max_packed)
    got = {r.pid: r.zone for r in got.collect()}
    assert got == _brute(points, cents)
    assert got[1001] == "Z003"


def test_tiles_follow_the_data(spark):
    """One centroid far away does not widen the cells of the others; ties in x, in y; every tile is bounded."""
    from patrolstat.operators.nearest import _prepared, tiles

    rnd = random.Random(3)
    cents = [(f"Z{i}", i, rnd.choice([0.5, rnd.random()]), rnd.choice([0.5, rnd.random()])) for i in range(9_999)] + [("FAR", 9_999, 1e9, -1e9)]
    cdf = spark.createDataFrame(cents, "zone string, ord long, cx double, cy double").repartition(5)
    prepared = _prepared(cdf, "cx", "cy", "zone", "ord")
    n = prepared.count()
    sizes = [len(r.members) for r in tiles(prepared, n, 32).collect()]
    assert max(sizes) <= 32 and sum(sizes) == n and len(sizes) < 2 * n / 32
    points = [(i, rnd.random(), rnd.random()) for i in range(150)] + [(1000, 1e9, -1e9 + 3), (1001, -1e7, 0.5), (1002, 0.5, 0.5)]
    pdf = spark.createDataFrame(points, "pid long, x double, y double")
    got = nearest_centroid(pdf, cdf, "x", "y", "cx", "cy", zone="zone", order="ord", max_packed=0, top=64)
    assert {r.pid: r.zone for r in got.collect()} == _brute(points, cents)


def test_points_at_one_place(spark):
    cdf = spark.range(5000).selectExpr("string(id) as zone", "id as ord", "double(id % 100) as cx", "double(id div 100) as cy")
    pdf = spark.range(3000).selectExpr("id as pid", "if(id % 3 = 0, 7.0D, double(id % 97)) as x", "if(id % 3 = 0, 7.0D, double(id % 43)) as y")
    got = nearest_centroid(pdf, cdf, "x", "y", "cx", "cy", zone="zone", order="ord", max_packed=0, max_distance=1.0, top=16)
    assert all(r.zone == str(int(r.x) + 100 * int(r.y)) and r.distance == 0 for r in got.collect()) and got.count() == 3000


def test_nearest_centroid_max_distance(spark):
    pdf = spark.createDataFrame([(1, 0.0, 0.0)], "pid long, x double, y double")
    cdf = spark.createDataFrame([("A", 1, 3.0, 4.0)], "zone string, ord long, cx double, cy double")
    r = nearest_centroid(pdf, cdf, "x", "y", "cx", "cy", "zone", "ord", max_distance=5.0).first()
    assert r.zone is None                                   # strict: distance must be < max
    r = nearest_centroid(pdf, cdf, "x", "y", "cx", "cy", "zone", "ord", max_distance=5.01).first()
    assert (r.zone, r.distance) == ("A", 5.0)


def test_assign_incident_zips(spark):
    inc = spark.createDataFrame([("1", "37.7750", "-122.5110"), ("2", None, None), ("3", "bad", "-122.4")],
                                "incident_id string, latitude string, longitude string")
    cents = spark.createDataFrame([("94175", 37.784827, -122.727802), ("94160", 37.784827, -122.727802),
                                   ("94121", 37.778, -122.49)], "zip string, latitude double, longitude double")
    out = {r.incident_id: r.zip for r in PR.assign_incident_zips(inc, cents.coalesce(1)).collect()}
    ties = spark.createDataFrame([("94175", 37.0, -122.0, 7), ("94160", 37.0, -122.0, 9), ("94199", 37.0, -122.0, 2)],
                                 "zip string, latitude double, longitude double, line long")
    assert PR.assign_incident_zips(inc.limit(1), ties).first().zip == "94199"                # first in the file
    assert PR.assign_incident_zips(inc.limit(1), ties.drop("line")).first().zip == "94160"   # no file: the smallest
    assert out == {"1": "94121", "2": "00000", "3": "00000"}


def test_nearest_centroid_plans_agree_on_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    points = [(1, 0.1, 0.1), (1, 9.0, 9.0), (None, 5.0, 5.2), (2, nan, 1.0), (3, inf, 1.0), (4, 1e20, -1e20), (5, None, 1.0), (6, -50.0, 3.0)]
    cents = [(f"Z{i}", i, float(i % 10), float(i // 10)) for i in range(100)]
    cents += [("SAME", 500, 3.0, 3.0), ("FAR", 501, 1e6, 1e6), ("NAN", 502, nan, 0.0), ("INF", 503, inf, 0.0), ("NULL", 504, None, 0.0)]
    pdf = spark.createDataFrame(points, "pid long, x double, y double")
    cdf = spark.createDataFrame(cents, "zone string, ord long, cx double, cy double")
    got = [sorted(map(str, nearest_centroid(pdf, cdf, "x", "y", "cx", "cy", "zone", "ord", missing_zone="00000",
                                            point_id="pid", max_packed=n, tile=t, top=6).collect())) for n, t in ((1024, 1), (0, 32), (0, 3))]
    assert got[0] == got[1] == got[2] and sum("zone='00000'" in r for r in got[0]) == 3
