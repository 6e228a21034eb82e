"""Driver queries: name -> (spark, sf_dir) -> DataFrame, with DuckDB oracle SQL.

Each query feeds a library operator with a stand-in built from the driver
tables (see :mod:`patrolstat.plans.standins`) and returns its whole result.
The oracle SQL recomputes the same result independently in DuckDB; column
names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrolstat.functions import categorize as cat
from patrolstat.functions import parsing as P
from patrolstat.functions.tables import N_SLOTS, bucket_names
from patrolstat.operators import aggregate as A
from patrolstat.operators import clean as C
from patrolstat.plans import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed stand-in incidents."""
    return C.typed_incidents(S.raw_incidents(spark, sf_dir))


INC = f"({S.typed_incidents_sql()})"


# --- flagship: slot profile --------------------------------------------------

def _slot_profile_sql() -> str:
    parts = ["count(slot) AS total_count"]
    for i in range(1, N_SLOTS + 1):
        parts += [
            f"count(*) FILTER (WHERE slot = {i}) AS slot{i}_count",
            f"CAST(sum(weight) FILTER (WHERE slot = {i}) AS DOUBLE)"
            f" / NULLIF(count(*) FILTER (WHERE slot = {i}), 0) AS slot{i}_mean_weight",
            f"count(*) FILTER (WHERE slot = {i} AND theft) AS slot{i}_theft_count",
        ]
    return f"""
    WITH s AS (SELECT zip, {S.slot_sql('hour')} AS slot, weight, {S.theft_sql('category')} AS theft
               FROM {INC} i),
    agg AS (SELECT zip, {', '.join(parts)} FROM s GROUP BY zip)
    SELECT p.*, agg.* EXCLUDE (zip) FROM ({S.zip_profile_sql()}) p JOIN agg USING (zip)
    """


@register("slot_profile", _slot_profile_sql())
def q_slot_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-zip profile: census attributes + per-slot count, mean weight, thefts."""
    return A.slot_profile(incidents(spark, sf_dir), S.zip_profile(spark, sf_dir), key="zip")


# --- categorisation -----------------------------------------------------------

@register("severity_weight", f"""
    SELECT incident_id, category, {S.weight_case_sql('category')} AS weight FROM {INC} i""")
def q_severity_weight(spark, sf_dir):
    return incidents(spark, sf_dir).select(
        "incident_id", "category", cat.severity_weight("category").alias("weight"))


@register("keyword_bucket", f"""
    SELECT incident_id, category, {S.bucket_case_sql('category')} AS bucket FROM {INC} i""")
def q_keyword_bucket(spark, sf_dir):
    return incidents(spark, sf_dir).select(
        "incident_id", "category", cat.keyword_bucket("category").alias("bucket"))


@register("hour_slot", f"""
    SELECT incident_id, hour, {S.slot_sql('hour')} AS slot FROM {INC} i""")
def q_hour_slot(spark, sf_dir):
    return incidents(spark, sf_dir).select(
        "incident_id", "hour", cat.hour_slot("hour").alias("slot"))


@register("calendar_parts", """
    SELECT event_id AS incident_id, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
           CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute FROM events""")
def q_calendar_parts(spark, sf_dir):
    """Month/day/hour/minute cut from the ``yyyy/MM/dd`` and ``HH:mm`` texts."""
    e = S.table(spark, sf_dir, "events")
    texts = e.select(F.col("event_id").alias("incident_id"),
                     F.date_format("ts", "yyyy/MM/dd").alias("d"),
                     F.date_format("ts", "HH:mm").alias("t"))
    return texts.select("incident_id", P.month_of("d").alias("month"), P.day_of("d").alias("day"),
                        P.hour_of("t").alias("hour"), P.minute_of("t").alias("minute"))


# --- cleaning -----------------------------------------------------------------

_USABLE_SQL = ("TRY_CAST(zip AS INTEGER) <> 0 AND incident_date IS NOT NULL AND incident_time IS NOT NULL"
               " AND year IS NOT NULL AND day_of_week IS NOT NULL AND category IS NOT NULL"
               " AND code IS NOT NULL AND weight <> 0")


@register("completeness_filter", f"""
    SELECT incident_id, zip, month, day, hour, minute, year, day_of_week, weight
    FROM {INC} i WHERE {_USABLE_SQL}""")
def q_completeness_filter(spark, sf_dir):
    return C.completeness_filter(incidents(spark, sf_dir)).select(
        "incident_id", "zip", "month", "day", "hour", "minute", "year", "day_of_week", "weight")


@register("coverage_ratio", f"""
    SELECT count(*) AS total_records,
           count(*) FILTER (WHERE coalesce({_USABLE_SQL}, false)) AS usable_records,
           CAST(count(*) FILTER (WHERE coalesce({_USABLE_SQL}, false)) AS DOUBLE)
             / CAST(count(*) AS DOUBLE) * 100.0 AS usable_percent,
           printf('%.2f%%', CAST(count(*) FILTER (WHERE coalesce({_USABLE_SQL}, false)) AS DOUBLE)
             / CAST(count(*) AS DOUBLE) * 100.0) AS usable_percent_text
    FROM {INC} i""")
def q_coverage_ratio(spark, sf_dir):
    return C.coverage(incidents(spark, sf_dir))


# --- keyword buckets ------------------------------------------------------------

def _bucket_counts_sql(group: str | None) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE bucket = '{b}') AS {A.bucket_column(b)}"
                       for b in bucket_names())
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return (f"SELECT {g}count(*) AS total_incidents, {counts} FROM "
            f"(SELECT *, {S.bucket_case_sql('category')} AS bucket FROM {INC} i) b{gb}")


@register("bucket_counts_total", _bucket_counts_sql(None))
def q_bucket_counts_total(spark, sf_dir):
    return A.bucket_counts(incidents(spark, sf_dir))


@register("bucket_counts_by_group", _bucket_counts_sql("district"))
def q_bucket_counts_by_group(spark, sf_dir):
    return A.bucket_counts(incidents(spark, sf_dir), group_by="district")


@register("bucket_shares", f"""
    WITH b AS (SELECT {S.bucket_case_sql('category')} AS bucket FROM {INC} i),
    t AS (SELECT count(*) AS total_incidents FROM b),
    names AS (SELECT unnest({S._sql_list(tuple(bucket_names()))}) AS bucket),
    c AS (SELECT names.bucket, count(b.bucket) AS incidents FROM names LEFT JOIN b USING (bucket)
          GROUP BY names.bucket)
    SELECT c.bucket, c.incidents, t.total_incidents,
           CAST(c.incidents AS DOUBLE) / CAST(t.total_incidents AS DOUBLE) AS share
    FROM c, t""")
def q_bucket_shares(spark, sf_dir):
    return A.bucket_shares(A.bucket_counts(incidents(spark, sf_dir)))


# --- parsing and ingest -----------------------------------------------------------

from patrolstat.operators import joins as J  # noqa: E402
from patrolstat.operators.nearest import nearest_centroid  # noqa: E402
from patrolstat.operators.stitch import segment_stitch  # noqa: E402
from patrolstat.sources import readers as R  # noqa: E402

RAW = f"({S.raw_incidents_sql()})"
TAGGED_FIELDS = ["incident_id", "incident_date", "incident_time", "incident_year", "day_of_week",
                 "incident_code", "category", "district"]

# Fixed-width layout of the rendered order records (0-based, end exclusive).
ORDER_LAYOUT = {"o_orderkey": (0, 12), "o_custkey": (12, 24), "o_orderstatus": (24, 25),
                "o_orderpriority": (25, 40)}


@register("fixed_width_parse", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def q_fixed_width_parse(spark, sf_dir):
    """Orders rendered as fixed-width lines, cut back into typed fields."""
    o = S.table(spark, sf_dir, "orders")
    lines = o.select(F.format_string("%012d%012d%-1s%-15s", "o_orderkey", "o_custkey",
                                     "o_orderstatus", "o_orderpriority").alias("value"))
    cut = R.parse_fixed_width(lines, ORDER_LAYOUT)
    return cut.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                      F.col("o_custkey").try_cast("bigint").alias("o_custkey"),
                      "o_orderstatus", F.rtrim("o_orderpriority").alias("o_orderpriority"))


@register("quoted_csv_parse", f"""
    SELECT incident_id, zip, incident_date, incident_time, category, district FROM {RAW} r""")
def q_quoted_csv_parse(spark, sf_dir):
    """CSV lines whose category holds commas inside quotes, parsed field-exact."""
    raw = S.raw_incidents(spark, sf_dir)
    cols = ["incident_id", "zip", "incident_date", "incident_time", "category", "district"]
    lines = raw.select(F.to_csv(F.struct(*cols)).alias("value"))
    schema = "incident_id bigint, zip string, incident_date string, incident_time string, " \
             "category string, district string"
    return lines.select(R.parse_csv_column("value", schema).alias("r")).select("r.*")


@register("empty_to_null", f"""
    SELECT incident_id,
      CASE WHEN incident_date = 'null' THEN NULL ELSE incident_date END AS incident_date,
      CASE WHEN incident_time = 'null' THEN NULL ELSE incident_time END AS incident_time,
      CASE WHEN day_of_week = 'null' THEN NULL ELSE day_of_week END AS day_of_week,
      CASE WHEN incident_code = 'null' THEN NULL ELSE incident_code END AS incident_code
    FROM {RAW} r""")
def q_empty_to_null(spark, sf_dir):
    """Lines with empty and blank fields (as in the raw export) -> NULLs."""
    raw = S.raw_incidents(spark, sf_dir)
    blank = {"incident_date": "", "incident_time": "", "day_of_week": "  ", "incident_code": " "}
    rendered = raw.select("incident_id", *[
        F.when(F.col(c) == "null", F.lit(v)).otherwise(F.col(c)).alias(c) for c, v in blank.items()])
    lines = rendered.select(F.concat_ws(",", *[F.col(c).cast("string") for c in rendered.columns])
                            .alias("value"))
    schema = "incident_id bigint, " + ", ".join(f"{c} string" for c in blank)
    parsed = lines.select(R.parse_csv_column("value", schema).alias("r")).select("r.*")
    return C.normalize_missing(parsed, list(blank))


@register("bracket_strip", f"""
    SELECT zip, {', '.join(TAGGED_FIELDS)} FROM
    (SELECT CAST(incident_id AS VARCHAR) AS incident_id, * EXCLUDE (incident_id) FROM {RAW} r) t""")
def q_bracket_strip(spark, sf_dir):
    """Zip-tagged text ``(zip,<csv>)``: brackets stripped, zip and fields split off."""
    raw = S.raw_incidents(spark, sf_dir)
    body = F.to_csv(F.struct(*[F.col(c).cast("string") for c in TAGGED_FIELDS]))
    lines = raw.select(F.concat(F.lit("("), F.col("zip"), F.lit(","), body, F.lit(")")).alias("value"))
    return R.parse_tagged_lines(lines, TAGGED_FIELDS)


@register("split_pick", """
    SELECT p_partkey, string_split(p_name, ' ')[1] AS word1, string_split(p_name, ' ')[2] AS word2,
           string_split(p_name, ' ')[3] AS word3 FROM part""")
def q_split_pick(spark, sf_dir):
    p = S.table(spark, sf_dir, "part")
    return p.select("p_partkey", *[P.split_pick("p_name", " ", i).alias(f"word{i + 1}") for i in range(3)])


@register("safe_int_cast", f"""
    SELECT incident_id, TRY_CAST(zip AS INTEGER) AS zip_number, TRY_CAST(incident_code AS INTEGER) AS code,
           TRY_CAST(incident_year AS INTEGER) AS year, TRY_CAST(category AS INTEGER) AS category_number
    FROM {RAW} r""")
def q_safe_int_cast(spark, sf_dir):
    raw = S.raw_incidents(spark, sf_dir)
    return raw.select("incident_id", P.safe_int("zip").alias("zip_number"),
                      P.safe_int("incident_code").alias("code"), P.safe_int("incident_year").alias("year"),
                      P.safe_int("category").alias("category_number"))


NATION_HEADER = "n_nationkey,n_name,n_regionkey"


@register("header_row_drop", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_header_row_drop(spark, sf_dir):
    """Two 'files' of nation lines, the first with its header line; header dropped."""
    n = S.table(spark, sf_dir, "nation")
    body = n.select(F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    header = n.agg(F.lit(NATION_HEADER).alias("value"))
    lines = A.union_sources(header, body)
    kept = C.drop_header_rows(lines, {"value": NATION_HEADER})
    return kept.select(R.parse_csv_column("value", "n_nationkey int, n_name string, n_regionkey int")
                       .alias("r")).select("r.*")


# --- joins ----------------------------------------------------------------------------

@register("semi_join_filter", """
    SELECT * FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'SMALL')""")
def q_semi_join_filter(spark, sf_dir):
    """Line items whose part is in the key list of SMALL parts."""
    li = S.table(spark, sf_dir, "lineitem")
    keys = S.table(spark, sf_dir, "part").filter(F.col("p_type") == "SMALL").select("p_partkey")
    return J.semi_join_filter(li, keys, key="l_partkey", keys_key="p_partkey")


@register("enrich_join", """
    SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment, c.c_nationkey
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_enrich_join(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                  "c_name", "c_mktsegment", "c_nationkey")
    return J.enrich_join(c, o, key="o_custkey")


@register("rekey_join", """
    SELECT c.c_nationkey, o.o_custkey, o.o_orderkey, o.o_orderstatus
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_rekey_join(spark, sf_dir):
    """Order records re-keyed from customer key to the customer's nation key."""
    o = S.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    m = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return J.rekey_join(o, m, old_key="o_custkey", new_key="c_nationkey")


SEGMENTS = ("p_name", "p_brand", "p_type", "p_size")


@register("segment_stitch", """
    SELECT p_partkey, p_name || ',' || p_brand || ',' || p_type || ',' || CAST(p_size AS VARCHAR) || ','
           AS record
    FROM part WHERE p_size <= 45""")
def q_segment_stitch(spark, sf_dir):
    """Part attributes as 4 numbered segment records (segment 3 missing for p_size > 45)."""
    p = S.table(spark, sf_dir, "part")
    segs = p.select("p_partkey", "p_size", F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("segment"), F.col(c).cast("string").alias("payload"))
        for i, c in enumerate(SEGMENTS)])).alias("s")) \
        .filter(~((F.col("s.segment") == 3) & (F.col("p_size") > 45))) \
        .select("p_partkey", "s.segment", "s.payload")
    return segment_stitch(segs, key="p_partkey", segment="segment", payload="payload",
                          n_segments=len(SEGMENTS))


_NEAREST_SQL = """
    WITH c AS (SELECT label AS zone, vec_id AS ord, CAST(embedding[1] AS DOUBLE) AS cx,
                      CAST(embedding[2] AS DOUBLE) AS cy
               FROM embeddings e WHERE vec_id = (SELECT min(vec_id) FROM embeddings e2 WHERE e2.label = e.label)),
    p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS px, CAST(embedding[2] AS DOUBLE) AS py FROM embeddings),
    d AS (SELECT p.vec_id, c.zone, c.ord, (c.cx - p.px) * (c.cx - p.px) + (c.cy - p.py) * (c.cy - p.py) AS d2
          FROM p, c),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, ord) AS rn FROM d)
    SELECT vec_id, zone, sqrt(d2) AS distance FROM r WHERE rn = 1"""


def _nearest(spark, sf_dir, max_packed):
    e = S.table(spark, sf_dir, "embeddings")
    pts = e.select("vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    firsts = A.dedup_keep_first(e.select("label", "vec_id", "embedding"), key="label", order_by="vec_id")
    cents = firsts.select(F.col("label").alias("zone"), F.col("vec_id").alias("ord"),
                          F.col("embedding")[0].alias("cx"), F.col("embedding")[1].alias("cy"))
    out = nearest_centroid(pts, cents, "x", "y", "cx", "cy", zone="zone", order="ord",
                           max_distance=10000.0, point_id="vec_id", max_packed=max_packed)
    return out.select("vec_id", "zone", "distance")


@register("nearest_centroid", _NEAREST_SQL)
def q_nearest_centroid(spark, sf_dir):
    """Each embedding's first two dims as a point; centroid per label = its lowest vec_id."""
    return _nearest(spark, sf_dir, max_packed=1024)


@register("nearest_centroid_grid", _NEAREST_SQL)
def q_nearest_centroid_grid(spark, sf_dir):
    """Same assignment through the tile plan (the plan used for large centroid tables)."""
    return _nearest(spark, sf_dir, max_packed=0)


@register("nearest_centroid_tiles", """
    WITH c AS (SELECT CAST(vec_id AS VARCHAR) AS zone, vec_id AS ord, CAST(embedding[3] AS DOUBLE) AS cx,
                      CAST(embedding[4] AS DOUBLE) AS cy FROM embeddings),
    p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS px, CAST(embedding[2] AS DOUBLE) AS py FROM embeddings),
    d AS (SELECT p.vec_id, c.zone, c.ord, (c.cx - p.px) * (c.cx - p.px) + (c.cy - p.py) * (c.cy - p.py) AS d2 FROM p, c),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, ord) AS rn FROM d)
    SELECT vec_id, zone, sqrt(d2) AS distance FROM r WHERE rn = 1""")
def q_nearest_centroid_tiles(spark, sf_dir):
    """As many centroids as points (dims 3 and 4 of every embedding), small tiles: several levels of boxes."""
    e = S.table(spark, sf_dir, "embeddings")
    pts = e.select("vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    cents = e.select(F.col("vec_id").cast("string").alias("zone"), F.col("vec_id").alias("ord"),
                     F.col("embedding")[2].alias("cx"), F.col("embedding")[3].alias("cy"))
    out = nearest_centroid(pts, cents, "x", "y", "cx", "cy", zone="zone", order="ord", max_packed=0, tile=4, top=16)
    return out.select("vec_id", "zone", "distance")


# --- dedup, first-seen, union ---------------------------------------------------------

_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_keep_first", f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber
      NULLS FIRST, {', '.join(c + ' NULLS FIRST' for c in _LI_REST)}) AS rn FROM lineitem) t WHERE rn = 1""")
def q_dedup_keep_first(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return A.dedup_keep_first(li, key="l_orderkey", order_by="l_linenumber")


@register("distinct_first_seen", """
    SELECT event_type, min(event_id) AS first_seen FROM events GROUP BY event_type""")
def q_distinct_first_seen(spark, sf_dir):
    return A.distinct_first_seen(S.table(spark, sf_dir, "events"), value="event_type", order_by="event_id")


@register("union_all_sources", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_union_all_sources(spark, sf_dir):
    """Orders arriving as two files (finished / other), columns in different order."""
    o = S.table(spark, sf_dir, "orders")
    first = o.filter(F.col("o_orderstatus") == "F")
    second = o.filter(~(F.col("o_orderstatus") == "F")).select(*reversed(o.columns))
    return A.union_sources(first, second)


# --- features ---------------------------------------------------------------------------

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402

from patrolstat.operators import features as FE  # noqa: E402
from patrolstat.operators import metrics as ME  # noqa: E402
from patrolstat.operators import models as MO  # noqa: E402


def _weekdays(spark, sf_dir):
    e = S.table(spark, sf_dir, "events")
    return e.select("event_id", F.date_format("ts", "EEEE").alias("day_of_week"))


def _freq_rank_sql(src: str, col: str) -> str:
    return (f"(SELECT {col}, CAST(row_number() OVER (ORDER BY c DESC, {col}) - 1 AS DOUBLE) AS idx "
            f"FROM (SELECT {col}, count(*) AS c FROM {src} GROUP BY {col}) f)")


@register("frequency_index", f"""
    SELECT e.event_id, e.event_type, r.idx AS type_index
    FROM events e JOIN {_freq_rank_sql('events', 'event_type')} r USING (event_type)""")
def q_frequency_index(spark, sf_dir):
    e = S.table(spark, sf_dir, "events").select("event_id", "event_type")
    return FE.frequency_index(e, "event_type", "type_index", keep_invalid=False)


@register("frequency_index_distributed", f"""
    SELECT o.o_orderkey, o.o_custkey, r.idx AS customer_index FROM orders o JOIN (
      SELECT v, CAST(row_number() OVER (ORDER BY c DESC, v) - 1 AS DOUBLE) AS idx
      FROM (SELECT CAST(o_custkey AS VARCHAR) AS v, count(*) AS c FROM orders GROUP BY o_custkey) f) r
      ON r.v = CAST(o.o_custkey AS VARCHAR)""")
def q_frequency_index_distributed(spark, sf_dir):
    """Customers by number of orders: a column whose values grow with the table."""
    o = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return FE.frequency_index_distributed(o, "o_custkey", "customer_index", keep_invalid=False)


_DOW_SQL = "(SELECT event_id, dayname(ts) AS day_of_week FROM events)"


def _one_hot_sql(idx: str, k: str) -> str:
    return f"list_transform(range(CAST({k} - 1 AS BIGINT)), lambda x: CAST({idx} = x AS DOUBLE))"


@register("one_hot", f"""
    WITH d AS {_DOW_SQL}, r AS {_freq_rank_sql('d', 'day_of_week')}, n AS (SELECT count(*) AS k FROM r)
    SELECT d.event_id, d.day_of_week, {_one_hot_sql('r.idx', 'n.k')} AS day_vec
    FROM d JOIN r USING (day_of_week), n""")
def q_one_hot(spark, sf_dir):
    """Weekday -> frequency index -> one-hot (last category dropped), as an array."""
    d = FE.frequency_index(_weekdays(spark, sf_dir), "day_of_week", "day_idx", keep_invalid=False)
    d = FE.one_hot(d, "day_idx", "day_vec_v")
    return d.select("event_id", "day_of_week", vector_to_array("day_vec_v").alias("day_vec"))


@register("dummy_columns", "SELECT event_id, " + ", ".join(
    f"CAST(dayname(ts) = '{d}' AS INTEGER) AS {d}" for d in FE.WEEKDAYS) + " FROM events")
def q_dummy_columns(spark, sf_dir):
    return FE.weekday_dummies(_weekdays(spark, sf_dir), "day_of_week").drop("day_of_week")


_TRAIN_SQL = f"""(SELECT incident_id, TRY_CAST(zip AS INTEGER) AS zipcode, month, day AS date, hour, minute,
    year, day_of_week AS dayOfWeek, weight AS label FROM {INC} i WHERE {_USABLE_SQL})"""


def training_rows(spark, sf_dir):
    return MO.training_frame(incidents(spark, sf_dir), keep=["incident_id"])


@register("assemble_features", f"""
    WITH t AS {_TRAIN_SQL}, r AS {_freq_rank_sql('t', 'dayOfWeek')}, n AS (SELECT count(*) AS k FROM r)
    SELECT t.incident_id, list_concat({_one_hot_sql('r.idx', 'n.k')},
      [CAST(zipcode AS DOUBLE), CAST(month AS DOUBLE), CAST(date AS DOUBLE), CAST(hour AS DOUBLE),
       CAST(minute AS DOUBLE), CAST(year AS DOUBLE)]) AS features
    FROM t JOIN r USING (dayOfWeek), n""")
def q_assemble_features(spark, sf_dir):
    """Weekday vector + zipcode, month, date, hour, minute, year in one feature vector."""
    t = training_rows(spark, sf_dir)
    t = FE.frequency_index(t, "dayOfWeek", "dayOfWeekIndex", keep_invalid=False)
    t = FE.one_hot(t, "dayOfWeekIndex", "dayOfWeekVec")
    t = FE.assemble(t, ["dayOfWeekVec", *FE.NUMERIC_FEATURES], "features_v")
    return t.select("incident_id", vector_to_array("features_v").alias("features"))


@register("key_split", """
    SELECT event_id, CASE WHEN (event_id * 7919 + 13) % 100 < 70 THEN 'train' ELSE 'test' END AS split
    FROM events""")
def q_key_split(spark, sf_dir):
    e = S.table(spark, sf_dir, "events").select("event_id")
    return FE.key_split(e, "event_id", 70, method="modular")


# --- evaluation (lineitem: true class = line number, rule-based prediction) ---------------

_PRED_SQL = """(SELECT CAST(l_linenumber AS DOUBLE) AS label,
    CAST(LEAST(7, floor(l_quantity / 7) + 1) AS DOUBLE) AS prediction FROM lineitem)"""


def _pred_pairs(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_linenumber").cast("double").alias("label"),
                     F.least(F.lit(7), F.floor(F.col("l_quantity") / 7) + 1).cast("double").alias("prediction"))


@register("confusion_matrix", f"""
    SELECT label, prediction, count(*) AS count FROM {_PRED_SQL} p GROUP BY label, prediction""")
def q_confusion_matrix(spark, sf_dir):
    return ME.confusion_counts(_pred_pairs(spark, sf_dir))


@register("confusion_matrix_wide", f"""
    WITH p AS {_PRED_SQL}, u AS (SELECT label AS x FROM p UNION SELECT prediction FROM p),
    c AS (SELECT a.x AS label, b.x AS prediction, count(p.label) AS n FROM u a CROSS JOIN u b
          LEFT JOIN p ON p.label = a.x AND p.prediction = b.x GROUP BY ALL)
    SELECT label, list(prediction ORDER BY prediction) AS predictions, list(n ORDER BY prediction) AS counts FROM c GROUP BY label""")
def q_confusion_matrix_wide(spark, sf_dir):
    """A row per label that occurs as either, with the counts of all labels in order."""
    wide = ME.confusion_matrix(_pred_pairs(spark, sf_dir))
    return wide.select("label", F.map_keys("counts").alias("predictions"), F.map_values("counts").alias("counts"))


_SUMMARY_SQL = f"""
    WITH conf AS (SELECT label, prediction, count(*) AS count FROM {_PRED_SQL} p GROUP BY ALL),
    pl AS (SELECT label, CAST(sum(count) AS BIGINT) AS support,
                  CAST(coalesce(sum(count) FILTER (WHERE label = prediction), 0) AS BIGINT) AS tp
           FROM conf GROUP BY label),
    s AS (SELECT CAST(sum(support) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS correct,
                 max(support) AS majority_support FROM pl)"""


@register("accuracy", _SUMMARY_SQL + """
    SELECT n, correct, CAST(correct AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy,
           CAST(majority_support AS DOUBLE) / CAST(n AS DOUBLE) AS majority_share FROM s""")
def q_accuracy(spark, sf_dir):
    return ME.summary_metrics(_pred_pairs(spark, sf_dir)).select("n", "correct", "accuracy", "majority_share")


@register("weighted_recall", _SUMMARY_SQL + """
    SELECT n, CAST(correct AS DOUBLE) / CAST(n AS DOUBLE) AS weighted_recall FROM s""")
def q_weighted_recall(spark, sf_dir):
    return ME.summary_metrics(_pred_pairs(spark, sf_dir)).select("n", "weighted_recall")


@register("metrics_by_label", f"""
    WITH conf AS (SELECT label, prediction, count(*) AS count FROM {_PRED_SQL} p GROUP BY ALL),
    tot AS (SELECT sum(count) AS n FROM conf),
    pl AS (SELECT label, CAST(sum(count) AS BIGINT) AS support,
                  CAST(coalesce(sum(count) FILTER (WHERE label = prediction), 0) AS BIGINT) AS tp
           FROM conf GROUP BY label),
    pp AS (SELECT prediction AS label, CAST(sum(count) AS BIGINT) AS predicted FROM conf GROUP BY prediction),
    m AS (SELECT pl.label, pl.support, pl.tp, coalesce(pp.predicted, 0) AS predicted FROM pl LEFT JOIN pp USING (label)),
    q AS (SELECT label, support, tp, predicted - tp AS fp, predicted,
            CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(predicted AS DOUBLE) END AS precision,
            CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) AS recall,
            coalesce(CAST(predicted - tp AS DOUBLE) / NULLIF(CAST(tot.n AS DOUBLE) - CAST(support AS DOUBLE), 0), 0.0)
              AS fpr
          FROM m, tot)
    SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                   ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM q""")
def q_metrics_by_label(spark, sf_dir):
    return ME.label_metrics(_pred_pairs(spark, sf_dir))


# --- models (rows-only checks: no value oracle for fitted models) ---------------------------

def _split_training(spark, sf_dir):
    t = FE.key_split(training_rows(spark, sf_dir), "incident_id", 70, method="hash")
    return t.filter(F.col("split") == "train").drop("split"), t.filter(F.col("split") == "test").drop("split")


def _fit_predict(spark, sf_dir, classifier):
    train, test = _split_training(spark, sf_dir)
    model = MO.fit(MO.classification_pipeline(classifier), train)
    return MO.predictions(model, test, keep=["incident_id"])


@register("rf_predict")
def q_rf_predict(spark, sf_dir):
    """Random forest (10 trees, depth 5) fitted on the train split, scored on the test split."""
    return _fit_predict(spark, sf_dir, MO.random_forest(num_trees=10, max_depth=5))


@register("dt_predict")
def q_dt_predict(spark, sf_dir):
    return _fit_predict(spark, sf_dir, MO.decision_tree(max_depth=5))


@register("lr_predict")
def q_lr_predict(spark, sf_dir):
    return _fit_predict(spark, sf_dir, MO.logistic_regression(max_iter=50))


@register("lr_coefficients")
def q_lr_coefficients(spark, sf_dir):
    train, _ = _split_training(spark, sf_dir)
    model = MO.fit(MO.classification_pipeline(MO.logistic_regression(max_iter=50)), train)
    return MO.lr_coefficients(spark, model)


@register("cv_scores")
def q_cv_scores(spark, sf_dir):
    """3-fold grid search (weighted recall) over a small random-forest grid."""
    train, _ = _split_training(spark, sf_dir)
    rf = MO.random_forest(num_trees=5, max_depth=3)
    res = MO.cross_validate(MO.classification_pipeline(rf), rf, {"maxDepth": [3, 5], "numTrees": [5]},
                            train, folds=3, parallelism=2)
    return MO.cv_scores_frame(spark, res)


@register("batch_score")
def q_batch_score(spark, sf_dir):
    """Fit on labelled train rows; score the raw text rows of the test split, labelled or not."""
    train, _ = _split_training(spark, sf_dir)
    model = MO.fit(MO.classification_pipeline(MO.random_forest(num_trees=10, max_depth=5)), train)
    raw = FE.key_split(S.raw_incidents(spark, sf_dir), "incident_id", 70, method="hash")
    return MO.score_raw(MO.raw_scorer(model), raw.filter(F.col("split") == "test"), keep=["incident_id"])


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Fitted pipeline saved to the shared checkpoint folder, loaded back and used to score."""
    import uuid

    from patrolstat.session import ensure_checkpoint_dir
    from patrolstat.sources.sinks import load_model, save_model
    train, test = _split_training(spark, sf_dir)
    model = MO.fit(MO.classification_pipeline(MO.decision_tree(max_depth=5)), train)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    save_model(model, path)
    return MO.predictions(load_model(path), test, keep=["incident_id"])


# --- models with a closed form: value checks ---------------------------------------------------
#
# A tree of depth 1 is a search for the threshold of least weighted gini impurity; a logistic
# regression on one one-hot column gives each value's class shares.  Labels are derived from the rows,
# so that there is something to learn.

def _stump_sql(train: str, x: str) -> str:
    """One row: the threshold ``q`` (left: ``x <= q``) and both sides' majority label, from ``train`` (``x``, 0/1 ``label``)."""
    def gini(n: str, p: str) -> str:
        return f"(1.0 - ({p} / {n}) * ({p} / {n}) - (({n} - {p}) / {n}) * (({n} - {p}) / {n}))"
    return f"""(SELECT q, CAST(2 * pl > nl AS INTEGER)::DOUBLE AS low, CAST(2 * (pt - pl) > nt - nl AS INTEGER)::DOUBLE AS high FROM (
        SELECT q, sum(n) OVER (ORDER BY q)::DOUBLE AS nl, sum(p) OVER (ORDER BY q)::DOUBLE AS pl,
               sum(n) OVER ()::DOUBLE AS nt, sum(p) OVER ()::DOUBLE AS pt
        FROM (SELECT {x} AS q, count(*) AS n, sum(label) AS p FROM {train} GROUP BY {x}) g) c
      WHERE nl < nt ORDER BY nl / nt * {gini('nl', 'pl')} + (nt - nl) / nt * {gini('(nt - nl)', '(pt - pl)')}, q LIMIT 1)"""


_MODULAR = "(({0} % 100) * 19 + 13) % 100 < 70"
_LATE_SQL = """(SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS quantity,
    CAST(l_quantity + 3 * l_linenumber > 40 AS INTEGER) AS label FROM lineitem)"""
_LATE_STUMP = _stump_sql(f"(SELECT * FROM {_LATE_SQL} t WHERE {_MODULAR.format('l_orderkey')}) t", "quantity")
_LATE_PREDICTED = f"""(SELECT l_orderkey, l_linenumber, quantity, label::DOUBLE AS label, CASE WHEN quantity <= q THEN low ELSE high END AS prediction
    FROM {_LATE_SQL} t, {_LATE_STUMP} s WHERE NOT {_MODULAR.format('l_orderkey')})"""


def _late(spark, sf_dir):
    """Line items with a 0/1 label that follows from quantity and line number; train and test part."""
    li = S.table(spark, sf_dir, "lineitem")
    rows = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("quantity"),
                     (F.col("l_quantity") + 3 * F.col("l_linenumber") > 40).cast("int").alias("label"))
    t = FE.key_split(rows, "l_orderkey", 70, method="modular")
    return t.filter("split = 'train'").drop("split"), t.filter("split = 'test'").drop("split")


def _late_pipeline(classifier):
    return Pipeline(stages=[VectorAssembler(inputCols=["quantity"], outputCol="features"), classifier])


def _late_predictions(spark, sf_dir, classifier):
    train, test = _late(spark, sf_dir)
    model = MO.fit(_late_pipeline(classifier), train)
    return MO.predictions(model, test, keep=["l_orderkey", "l_linenumber", "quantity"])


@register("dt_stump", f"SELECT * FROM {_LATE_PREDICTED} p")
def q_dt_stump(spark, sf_dir):
    """A decision tree of depth 1 on the quantity."""
    return _late_predictions(spark, sf_dir, MO.decision_tree(max_depth=1, max_bins=64))


@register("forest_stump", f"SELECT * FROM {_LATE_PREDICTED} p")
def q_forest_stump(spark, sf_dir):
    """A forest of three such trees that see all rows and features: each is the tree."""
    forest = MO.random_forest(num_trees=3, max_depth=1, max_bins=64).setBootstrap(False).setFeatureSubsetStrategy("all")
    return _late_predictions(spark, sf_dir, forest)


@register("stump_evaluation", f"""
    WITH p AS {_LATE_PREDICTED}, n AS (SELECT count(*) AS n FROM p),
    l AS (SELECT label, count(*) AS support, count(*) FILTER (WHERE prediction = label) AS tp FROM p GROUP BY label),
    q AS (SELECT prediction AS label, count(*) AS predicted FROM p GROUP BY prediction),
    m AS (SELECT l.*, coalesce(predicted, 0) AS predicted FROM l LEFT JOIN q USING (label)),
    r AS (SELECT label, support, tp, predicted - tp AS fp, predicted,
            CASE WHEN predicted = 0 THEN 0.0 ELSE tp::DOUBLE / predicted::DOUBLE END AS precision, tp::DOUBLE / support::DOUBLE AS recall,
            coalesce((predicted - tp)::DOUBLE / NULLIF(n::DOUBLE - support::DOUBLE, 0), 0.0) AS fpr FROM m, n)
    SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM r""")
def q_stump_evaluation(spark, sf_dir):
    """Per-label metrics of the fitted tree on its test rows."""
    return ME.label_metrics(q_dt_stump(spark, sf_dir))


@register("cv_stump_scores", f"""
    WITH t AS (SELECT *, l_orderkey % 3 AS fold FROM {_LATE_SQL} x WHERE {_MODULAR.format('l_orderkey')}),
    f AS (SELECT 0 AS fold, * FROM {_stump_sql('(SELECT * FROM t WHERE fold <> 0)', 'quantity')}
          UNION ALL SELECT 1, * FROM {_stump_sql('(SELECT * FROM t WHERE fold <> 1)', 'quantity')}
          UNION ALL SELECT 2, * FROM {_stump_sql('(SELECT * FROM t WHERE fold <> 2)', 'quantity')}),
    m AS (SELECT b.fold, CAST(2 * sum(a.label) > count(*) AS INTEGER) AS most FROM (SELECT DISTINCT fold FROM t) b
          JOIN t a ON a.fold <> b.fold GROUP BY b.fold),
    s AS (SELECT fold, avg(CAST(label = CASE WHEN quantity <= q THEN low ELSE high END AS INTEGER)) AS deep,
                 avg(CAST(label = most AS INTEGER)) AS flat FROM t JOIN f USING (fold) JOIN m USING (fold) GROUP BY fold)
    SELECT 'maxDepth=0' AS params, round(avg(flat), 6) AS avg_metric FROM s
    UNION ALL SELECT 'maxDepth=1', round(avg(deep), 6) FROM s""")
def q_cv_stump_scores(spark, sf_dir):
    """Cross-validated weighted recall of trees of depth 0 and 1, folds by order key."""
    train, _ = _late(spark, sf_dir)
    dt = MO.decision_tree(max_bins=64)
    res = MO.cross_validate(_late_pipeline(dt), dt, {"maxDepth": [0, 1]}, train, folds=3, fold=F.pmod(F.col("l_orderkey"), F.lit(3)))
    return MO.cv_scores_frame(spark, res).withColumn("avg_metric", F.round("avg_metric", 6))


_TIER_SQL = """(SELECT l_orderkey, l_linenumber, CAST(least(2, floor((l_quantity + 6 * l_linenumber) / 30)) AS DOUBLE) AS label FROM lineitem)"""


@register("lr_class_shares", f"""
    WITH t AS {_TIER_SQL}, c AS (SELECT l_linenumber, label, count(*) AS n FROM t WHERE {_MODULAR.format('l_orderkey')} GROUP BY ALL),
    best AS (SELECT l_linenumber, arg_max(label, n) AS prediction FROM c GROUP BY l_linenumber)
    SELECT l_orderkey, l_linenumber, label, prediction FROM t JOIN best USING (l_linenumber) WHERE NOT {_MODULAR.format('l_orderkey')}""")
def q_lr_class_shares(spark, sf_dir):
    """Multinomial logistic regression on one one-hot column: the most frequent class of each value."""
    li = S.table(spark, sf_dir, "lineitem")
    rows = li.select("l_orderkey", "l_linenumber", F.least(F.lit(2), F.floor((F.col("l_quantity") + 6 * F.col("l_linenumber")) / 30))
                     .cast("double").alias("label"))
    t = FE.key_split(rows, "l_orderkey", 70, method="modular")
    model = MO.fit(Pipeline(stages=[*FE.indexed_one_hot_stages(["l_linenumber"]), MO.logistic_regression()]), t.filter("split = 'train'").drop("split"))
    return MO.predictions(model, t.filter("split = 'test'"), keep=["l_orderkey", "l_linenumber"])


_SERIOUS = "CAST(hour >= 15 OR weight >= 14 AS INTEGER)"
_RAW_TEST_SQL = f"""(SELECT incident_id, hour FROM {INC} i WHERE NOT {_MODULAR.format('incident_id')}
    AND TRY_CAST(zip AS INTEGER) <> 0 AND month IS NOT NULL AND day IS NOT NULL AND hour IS NOT NULL AND minute IS NOT NULL
    AND year IS NOT NULL AND day_of_week IS NOT NULL)"""
_RAW_STUMP = _stump_sql(f"(SELECT hour, {_SERIOUS} AS label FROM {INC} i WHERE {_USABLE_SQL} AND {_MODULAR.format('incident_id')}) t", "hour")


def _serious_tree(spark, sf_dir):
    """A tree of depth 1 on all seven features, fitted to "late or serious", as a scorer of raw rows; the raw test rows."""
    inc = FE.key_split(incidents(spark, sf_dir), "incident_id", 70, method="modular").filter("split = 'train'")
    label = ((F.col("hour") >= 15) | (F.col("weight") >= 14)).cast("int")
    train = MO.training_frame(inc.drop("split"), keep=["weight"]).withColumn("label", label).drop("weight")
    model = MO.fit(MO.classification_pipeline(MO.decision_tree(max_depth=1)), train)
    raw = FE.key_split(S.raw_incidents(spark, sf_dir), "incident_id", 70, method="modular")
    return MO.raw_scorer(model), raw.filter("split = 'test'")


@register("raw_batch_score", f"""
    SELECT incident_id, CASE WHEN hour <= q THEN low ELSE high END AS prediction FROM {_RAW_TEST_SQL} t, {_RAW_STUMP} s""")
def q_raw_batch_score(spark, sf_dir):
    """Raw text rows scored by a pipeline that holds its own preprocessing."""
    scorer, raw = _serious_tree(spark, sf_dir)
    return MO.score_raw(scorer, raw, keep=["incident_id"])


@register("model_roundtrip_counts", f"""
    SELECT count(*) AS scored_rows, count(*) AS equal_rows, CAST(sum(CASE WHEN hour <= q THEN low ELSE high END) AS BIGINT) AS positives
    FROM {_RAW_TEST_SQL} t, {_RAW_STUMP} s""")
def q_model_roundtrip_counts(spark, sf_dir):
    """The raw-row scorer saved, loaded and used: rows scored, rows scored alike by both, positive predictions."""
    import uuid

    from patrolstat.session import ensure_checkpoint_dir
    from patrolstat.sources.sinks import load_model, save_model
    scorer, raw = _serious_tree(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    save_model(scorer, path)
    before = MO.score_raw(scorer, raw, keep=["incident_id"]).withColumnRenamed("prediction", "first")
    after = MO.score_raw(load_model(path), raw, keep=["incident_id"])
    return after.join(before, "incident_id", "left").agg(
        F.count("*").alias("scored_rows"), F.count_if(F.col("first") == F.col("prediction")).alias("equal_rows"),
        F.sum("prediction").cast("long").alias("positives"))


# --- files ------------------------------------------------------------------------------------

from patrolstat.sources.lines import with_line_numbers  # noqa: E402


def _written_lines(lines: DataFrame) -> str:
    import uuid

    from patrolstat.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(lines.sparkSession).rstrip('/')}/lines-{uuid.uuid4().hex}"
    lines.write.text(path)
    return path


@register("file_line_numbers", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS line FROM orders""")
def q_file_line_numbers(spark, sf_dir):
    """Orders written in key order as ';' lines to several files, read back and numbered."""
    o = S.table(spark, sf_dir, "orders")
    path = _written_lines(o.orderBy("o_orderkey").select(F.concat_ws(";", "o_orderkey", "o_orderstatus").alias("value")))
    rows = R.read_headerless(spark, path, ["key", "status"], sep=";")
    return with_line_numbers(rows).select(F.col("key").cast("long").alias("o_orderkey"), "line")


_LINES_SQL = """(SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderkey,
    CASE o_orderkey % 10 WHEN 3 THEN k WHEN 7 THEN k || ',F,extra' WHEN 9 THEN '"' || k || ',F' ELSE k || ',"' || o_orderstatus || ', x"' END AS line
    FROM orders)"""


@register("quarantined_rows", f"""
    SELECT line AS raw, CASE o_orderkey % 10 WHEN 9 THEN k || ',F' ELSE k END AS k FROM {_LINES_SQL} t WHERE o_orderkey % 10 IN (3, 7, 9)
    UNION ALL SELECT NULL, k FROM {_LINES_SQL} t WHERE o_orderkey % 10 NOT IN (3, 7, 9)""")
def q_quarantined_rows(spark, sf_dir):
    """Order lines, some too short, too long or with a quote never closed: the good rows, and the raw text of the others."""
    k = F.col("o_orderkey").cast("string")
    kind = F.pmod("o_orderkey", F.lit(10))
    line = (F.when(kind == 3, k).when(kind == 7, F.concat(k, F.lit(",F,extra"))).when(kind == 9, F.concat(F.lit('"'), k, F.lit(",F")))
            .otherwise(F.concat(k, F.lit(',"'), "o_orderstatus", F.lit(', x"'))))
    path = _written_lines(S.table(spark, sf_dir, "orders").select(line.alias("value")))
    rows = R.read_delimited(spark, path, R.string_schema(["k", "status"]), header=False, corrupt_column=R.CORRUPT)
    good, bad = R.split_malformed(rows)
    return bad.select(F.col(R.CORRUPT).alias("raw"), "k").unionByName(good.select(F.lit(None).cast("string").alias("raw"), "k"))


# --- rendering ----------------------------------------------------------------------------

from patrolstat.operators.render import render_buckets, render_profile  # noqa: E402

_CENSUS_LABELS = [("Name", "c_name"), ("Segment", "c_mktsegment")]


def _profile_text_sql() -> str:
    def ftxt(c: str) -> str:
        return f"coalesce(CAST(CAST({c} AS FLOAT) AS VARCHAR), 'NaN')"
    slots = []
    for i in range(1, N_SLOTS + 1):
        lo, hi = (i - 1) * 6, i * 6
        slots.append(
            f"'incidentCount(hour {lo} - {hi}): {{' || CAST(slot{i}_count AS VARCHAR) || "
            f"'}}; averageIncidentWeight(hour {lo} - {hi}): {{' || {ftxt(f'slot{i}_mean_weight')} || "
            f"'}}; theftCounts({lo} - {hi}): {{' || CAST(slot{i}_theft_count AS VARCHAR) || '}}'")
    census = " || '; ' || ".join(f"'{label}: ' || coalesce(CAST({c} AS VARCHAR), 'null')"
                                 for label, c in _CENSUS_LABELS)
    body = " || '----' || ".join(["'totalIncidentCount: ' || CAST(total_count AS VARCHAR)"] + slots)
    return (f"SELECT zip, '(' || zip || ',(censusData: {{' || {census} || '}},' || {body} || '))' "
            f"AS profile_text FROM ({_slot_profile_sql()}) sp")


@register("profile_text", _profile_text_sql())
def q_profile_text(spark, sf_dir):
    """The flagship slot profile rendered as labelled text records."""
    return render_profile(q_slot_profile(spark, sf_dir), "zip", _CENSUS_LABELS)


@register("rf_evaluation")
def q_rf_evaluation(spark, sf_dir):
    """Per-label precision, recall, FPR and F1 of the random forest on the test split."""
    return ME.label_metrics(q_rf_predict(spark, sf_dir))


# Record labels as the rendered text must have them, in their order (fixed values, stated here anew for the check).
_BUCKET_TEXT = [("Total Incidents", "total_incidents"), ("Vehicle Incidents", "vehicle_incidents"), ("Theft Incidents", "theft_incidents"),
                ("Drug/Liquor Incidents", "drug_incidents"), ("Incidents Involving Weapons", "weapon_incidents"),
                ("Sexual Incidents", "sexual_incidents"), ("Violent Incidents/Suicide", "violent_incidents"),
                ("Incidents Involving Offenses", "offense_incidents"), ("Reporting Incidents", "report_incidents"),
                ("Other Incidents", "other_incidents")]


@register("bucket_text", "SELECT district, " + " || '; ' || ".join(
    f"'{label}: ' || {column}" for label, column in _BUCKET_TEXT) + f" AS bucket_text FROM ({_bucket_counts_sql('district')}) c")
def q_bucket_text(spark, sf_dir):
    """The bucket counts of each district as labelled text records."""
    return render_buckets(q_bucket_counts_by_group(spark, sf_dir), "district")
