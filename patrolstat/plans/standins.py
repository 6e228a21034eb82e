"""Stand-in inputs built from the driver's test tables.

The driver tables hold no police incidents, so each driver query feeds the
library's operators with rows *in the schema they expect*, derived from a
real table.  These builders only shape input (rename, render, pick a label
from a fixed pool); they do none of the operators' work, and the operators
take nothing from how the rows were made.  Each builder has a SQL twin so
the DuckDB oracle sees exactly the same input.

Sentinel markers (``'null'`` text, zip ``00000``) are placed by residues of
the row id so that every missing-value path of the cleaning operators is
exercised on every scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrolstat.functions.tables import all_weighted_categories

# Stand-in label pools (inputs only; the operators never read these lists).
# The incident category pool is every category of the severity table, with
# the event's own type appended as a category no rule knows.
CATEGORY_POOL: tuple[str, ...] = tuple(all_weighted_categories())
DISTRICT_POOL: tuple[str, ...] = (
    "Southern", "Tenderloin", "Richmond", "Mission", "Northern", "Central",
    "Taraval", "Ingleside", "Out of SF", "Park", "Bayview",
)
# Residues that mark a field missing in the raw incident stand-in.
MISSING_ZIP_MOD, MISSING_DATE_MOD, MISSING_TIME_MOD = 23, 29, 31
MISSING_DOW_MOD, MISSING_CODE_MOD = 37, 41
MISSING_CATEGORY_MOD, NULL_CATEGORY_MOD = 43, 47
CATEGORY_STRIDE = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_list(values: tuple[str, ...], *extra: str) -> str:
    return "list_value(" + ", ".join([_sql_str(v) for v in values] + list(extra)) + ")"


# --- raw incidents (events) -------------------------------------------------

def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip-tagged raw incident fields (all text, ``'null'`` markers), derived from ``events``."""
    e = table(spark, sf_dir, "events")
    n_pool = len(CATEGORY_POOL) + 1
    idx = F.pmod(F.col("event_id") * CATEGORY_STRIDE + F.col("user_id"), F.lit(n_pool)).cast("int")
    # The pool is a fixed 50-row lookup table (size bounded by construction);
    # the category arrives as a plain column, as it does from a CSV file.
    pool = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_idx"), F.lit(c).alias("_pool_category"))
        for i, c in enumerate(CATEGORY_POOL)])))
    districts = F.array(*[F.lit(d) for d in DISTRICT_POOL])

    def marked(mod: int, value):
        return F.when(F.pmod(F.col("event_id"), F.lit(mod)) == 0, F.lit("null")).otherwise(value)

    # The text columns are made in one generated row, so that what reads them uses them as
    # plain columns, as from a file: projections and filters are not merged through a generator.
    made = e.select(F.inline(F.array(F.struct(
        F.col("event_id").alias("incident_id"),
        F.when(F.pmod(F.col("event_id"), F.lit(MISSING_ZIP_MOD)) == 0, F.lit("00000"))
        .otherwise(F.col("user_id").cast("string")).alias("zip"),
        marked(MISSING_DATE_MOD, F.date_format("ts", "yyyy/MM/dd")).alias("incident_date"),
        marked(MISSING_TIME_MOD, F.date_format("ts", "HH:mm")).alias("incident_time"),
        F.year("ts").cast("string").alias("incident_year"),
        marked(MISSING_DOW_MOD, F.date_format("ts", "EEEE")).alias("day_of_week"),
        marked(MISSING_CODE_MOD, F.lpad((idx + 1000).cast("string"), 5, "0")).alias("incident_code"),
        F.element_at(districts, (F.pmod(F.col("user_id"), F.lit(len(DISTRICT_POOL))) + 1).cast("int")).alias("district"),
        "event_type", idx.alias("_idx")))))
    return made.join(F.broadcast(pool), on="_idx", how="left").select(
        "incident_id", "zip", "incident_date", "incident_time", "incident_year", "day_of_week", "incident_code",
        F.when(F.pmod(F.col("incident_id"), F.lit(MISSING_CATEGORY_MOD)) == 0, F.lit("null"))
        .when(F.pmod(F.col("incident_id"), F.lit(NULL_CATEGORY_MOD)) == 0, F.lit(None))
        .otherwise(F.coalesce(F.col("_pool_category"), F.col("event_type"))).alias("category"), "district")


def raw_incidents_sql() -> str:
    n_pool = len(CATEGORY_POOL) + 1
    return f"""
    SELECT event_id AS incident_id,
      CASE WHEN event_id % {MISSING_ZIP_MOD} = 0 THEN '00000' ELSE CAST(user_id AS VARCHAR) END AS zip,
      CASE WHEN event_id % {MISSING_DATE_MOD} = 0 THEN 'null' ELSE strftime(ts, '%Y/%m/%d') END AS incident_date,
      CASE WHEN event_id % {MISSING_TIME_MOD} = 0 THEN 'null' ELSE strftime(ts, '%H:%M') END AS incident_time,
      CAST(year(ts) AS VARCHAR) AS incident_year,
      CASE WHEN event_id % {MISSING_DOW_MOD} = 0 THEN 'null' ELSE dayname(ts) END AS day_of_week,
      CASE WHEN event_id % {MISSING_CODE_MOD} = 0 THEN 'null'
           ELSE lpad(CAST(idx + 1000 AS VARCHAR), 5, '0') END AS incident_code,
      CASE WHEN event_id % {MISSING_CATEGORY_MOD} = 0 THEN 'null' WHEN event_id % {NULL_CATEGORY_MOD} = 0 THEN NULL
           ELSE {_sql_list(CATEGORY_POOL, 'event_type')}[idx + 1] END AS category,
      {_sql_list(DISTRICT_POOL)}[user_id % {len(DISTRICT_POOL)} + 1] AS district
    FROM (SELECT *, (event_id * {CATEGORY_STRIDE} + user_id) % {n_pool} AS idx FROM events) e
    """


def typed_incidents_sql() -> str:
    """SQL twin of ``operators.clean.typed_incidents(raw_incidents(...))``."""
    def nz(c: str) -> str:
        return f"CASE WHEN trim({c}) = '' OR {c} = 'null' THEN NULL ELSE {c} END"
    return f"""
    SELECT incident_id,
      CASE WHEN trim(zip) = '' OR zip IN ('null', '00000') THEN NULL ELSE zip END AS zip,
      {nz('incident_date')} AS incident_date, {nz('incident_time')} AS incident_time,
      {nz('incident_year')} AS incident_year, {nz('day_of_week')} AS day_of_week,
      {nz('incident_code')} AS incident_code, {nz('category')} AS category, district,
      TRY_CAST({nz('incident_year')} AS INTEGER) AS year,
      TRY_CAST({nz('incident_code')} AS INTEGER) AS code,
      TRY_CAST(substr({nz('incident_date')}, 6, 2) AS INTEGER) AS month,
      TRY_CAST(substr({nz('incident_date')}, 9, 2) AS INTEGER) AS day,
      TRY_CAST(substr({nz('incident_time')}, 1, 2) AS INTEGER) AS hour,
      TRY_CAST(substr({nz('incident_time')}, 4, 2) AS INTEGER) AS minute,
      {weight_case_sql(nz('category'))} AS weight
    FROM ({raw_incidents_sql()}) r
    """


# --- zip profile (customer) -------------------------------------------------

def zip_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile row per zip key, from ``customer`` (the census stand-in)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("zip"),
                    "c_name", "c_mktsegment", "c_acctbal")


def zip_profile_sql() -> str:
    return ("SELECT CAST(c_custkey AS VARCHAR) AS zip, c_name, c_mktsegment, c_acctbal "
            "FROM customer")


# --- SQL twins of the fixed-table expressions -------------------------------

def weight_case_sql(category: str) -> str:
    from patrolstat.functions.tables import SEVERITY_WEIGHTS, UNKNOWN_WEIGHT
    arms = " ".join(
        f"WHEN {category} IN ({', '.join(_sql_str(c) for c in cats)}) THEN {w}"
        for w, cats in SEVERITY_WEIGHTS)
    return f"(CASE {arms} ELSE {UNKNOWN_WEIGHT} END)"


def bucket_case_sql(category: str) -> str:
    from patrolstat.functions.tables import BUCKET_RULES, OTHER_BUCKET
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains({category}, {_sql_str(w)})" for w in words)
        + f" THEN {_sql_str(b)}" for b, words in BUCKET_RULES)
    return f"(CASE {arms} ELSE {_sql_str(OTHER_BUCKET)} END)"


def theft_sql(category: str) -> str:
    from patrolstat.functions.tables import THEFT_CATEGORIES
    return f"coalesce({category} IN ({', '.join(_sql_str(c) for c in THEFT_CATEGORIES)}), false)"


def slot_sql(hour: str) -> str:
    return f"(CASE WHEN {hour} >= 0 AND {hour} < 24 THEN CAST(floor({hour} / 6) AS INTEGER) + 1 END)"
