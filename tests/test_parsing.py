from pyspark.sql import functions as F

from patrolstat.functions import parsing as P


def test_fixed_slice_and_tail(spark):
    df = spark.createDataFrame([("0123456789",), ("0123",)], "v string")
    r = df.select(P.fixed_slice("v", 2, 5).alias("a"), P.tail_from("v", 6).alias("b")).collect()
    assert (r[0].a, r[0].b) == ("234", "6789")
    assert (r[1].a, r[1].b) == (None, None)


def test_tail_has_no_largest_length(spark):
    from patrolstat.sources import readers

    df = spark.createDataFrame([("94102,a,b",)], "value string")
    for out in (df.select(P.tail_from("value", 6)), readers.parse_tagged_lines(df, ["x", "y"])):
        assert str(1 << 30) not in out._jdf.queryExecution().analyzed().toString()


def test_strip_split_null_int(spark):
    df = spark.createDataFrame([("(94102,a b)",)], "v string")
    r = df.select(P.strip_brackets("v").alias("s")).first().s
    assert r == "94102,a b"
    r = df.select(P.split_pick(P.strip_brackets("v"), ",", 1).alias("a"),
                  P.split_pick("v", ",", 5).alias("b")).first()
    assert (r.a, r.b) == ("a b", None)
    df = spark.createDataFrame([("null",), ("  ",), ("06374",), ("x",)], "v string")
    got = df.select(P.null_if_missing("v").alias("n"), P.safe_int("v").alias("i")).collect()
    assert [g.n for g in got] == [None, None, "06374", "x"]
    assert [g.i for g in got] == [None, None, 6374, None]


def test_calendar_parts(spark):
    df = spark.createDataFrame([("2019/08/15", "11:41"), ("null", "nu")], "d string, t string")
    r = df.select(P.month_of("d").alias("m"), P.day_of("d").alias("d"),
                  P.hour_of("t").alias("h"), P.minute_of("t").alias("mi")).collect()
    assert tuple(r[0]) == (8, 15, 11, 41)
    assert tuple(r[1]) == (None, None, None, None)


def test_percent_and_float_text(spark):
    df = spark.createDataFrame([(256796, 272646, 10.293457, None)],
                               "n long, d long, m double, e double")
    r = df.select(P.percent_text(P.ratio_percent("n", "d")).alias("p"), P.float_text("m").alias("f"),
                  P.float_text("e").alias("e")).first()
    assert r.p == "94.19%"
    assert r.f == "10.293457"
    assert r.e == "NaN"
    z = spark.createDataFrame([(1, 0)], "n long, d long").select(P.ratio_percent("n", "d").alias("r")).first()
    assert z.r is None
