"""Sources: text lines, delimited files, zip-tagged incident text, census files.

Every reader uses an explicit schema (no ``inferSchema`` pass over the data:
inference costs a full extra scan and turns zip codes into integers and
times into timestamps).  Parsing of lines already held in a column uses
``from_csv`` with the same options, so the quote-aware split happens in the
JVM reader instead of a hand-written character loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patrolstat.functions.parsing import fixed_slice, strip_brackets, tail_from
from patrolstat.functions.tables import (
    CENSUS_GEO_LOGRECNO,
    CENSUS_GEO_ZCTA5,
    CENSUS_SEGMENT_LOGRECNO,
    CENSUS_SEGMENT_PAYLOAD_START,
)
from patrolstat.sources.lines import with_line_numbers

# --- FIXED VALUES: file formats of the inputs --------------------------------

# Header of the raw police incident CSV, in file order.
INCIDENT_CSV_COLUMNS: tuple[str, ...] = (
    "Incident Datetime", "Incident Date", "Incident Time", "Incident Year",
    "Incident Day of Week", "Report Datetime", "Row ID", "Incident ID",
    "Incident Number", "CAD Number", "Report Type Code",
    "Report Type Description", "Filed Online", "Incident Code",
    "Incident Category", "Incident Subcategory", "Incident Description",
    "Resolution", "Intersection", "CNN", "Police District",
    "Analysis Neighborhood", "Supervisor District", "Latitude", "Longitude",
    "point", "SF Find Neighborhoods", "Current Police Districts",
    "Current Supervisor Districts", "Analysis Neighborhoods",
    "HSOC Zones as of 2018-06-05", "OWED Public Spaces",
    "Central Market/Tenderloin Boundary Polygon - Updated",
    "Parks Alliance CPSI (27+TL sites)", "ESNCAG - Boundary File",
)

# Header of the ';'-delimited zip centroid file.
ZIP_CENTROID_COLUMNS: tuple[str, ...] = (
    "Zip", "City", "State", "Latitude", "Longitude", "Timezone",
    "Daylight savings time flag", "geopoint",
)

# --- end of fixed values ----------------------------------------------------

# Raw incident columns the analytics use, under snake_case names.
INCIDENT_FIELDS: dict[str, str] = {
    "Incident Date": "incident_date",
    "Incident Time": "incident_time",
    "Incident Year": "incident_year",
    "Incident Day of Week": "day_of_week",
    "Incident ID": "incident_id",
    "Incident Code": "incident_code",
    "Incident Category": "category",
    "Police District": "district",
    "Latitude": "latitude",
    "Longitude": "longitude",
}


def string_schema(names: tuple[str, ...] | list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


INCIDENT_CSV_SCHEMA = string_schema(INCIDENT_CSV_COLUMNS)
ZIP_CENTROID_SCHEMA = T.StructType([
    T.StructField("zip", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("timezone", T.IntegerType(), True),
    T.StructField("dst", T.IntegerType(), True),
    T.StructField("geopoint", T.StringType(), True),
])


#: The column of the raw text of malformed rows, where a reader is asked for it without a name.
CORRUPT = "_corrupt_record"


# --- generic readers --------------------------------------------------------

def read_lines(spark: SparkSession, path: str | list[str], min_partitions: int | None = None) -> DataFrame:
    """Text lines in column ``value``.

    Split sizes come from ``spark.sql.files.maxPartitionBytes``; with
    ``min_partitions`` the lines are dealt round-robin to that many (one shuffle).
    """
    df = spark.read.text(path)
    return df if min_partitions is None else df.repartition(min_partitions)


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   header: bool = True, sep: str = ",", null_value: str | None = None,
                   corrupt_column: str | None = None) -> DataFrame:
    """Delimited text with quotes honoured, an explicit schema and PERMISSIVE mode.

    Malformed rows are kept: their missing fields are NULL and, when
    ``corrupt_column`` is given, the raw line is kept in that column.  A row is
    malformed by its whole line (too few or too many fields, a quote never
    closed, a value of the wrong type), whatever columns a query selects: with
    that column the reader parses all fields.
    """
    reader = (spark.read.schema(_with_corrupt(schema, corrupt_column))
              .option("header", header).option("sep", sep)
              .option("quote", '"').option("escape", '"')
              .option("mode", "PERMISSIVE").option("multiLine", False))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
    rows = reader.csv(path)
    if corrupt_column:
        # Spark refuses to read that column alone: it now goes with the first field (nullif of a value with itself is NULL)
        first = F.col(f"`{schema.fields[0].name}`").cast("string")
        rows = rows.withColumn(corrupt_column, F.coalesce(F.col(corrupt_column), F.nullif(first, first)))
    return rows


def split_malformed(rows: DataFrame, corrupt_column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``: the well-formed rows without ``corrupt_column``, and the raw lines of the
    others with the fields that could be read.  Both are lazy; each scans its source."""
    bad = F.col(corrupt_column).isNotNull()
    return rows.filter(~bad).drop(corrupt_column), rows.filter(bad)


def malformed_count(rows: DataFrame, corrupt_column: str = CORRUPT) -> DataFrame:
    """One row: ``total_lines, malformed_lines`` (one scan)."""
    return rows.agg(F.count("*").alias("total_lines"), F.count(corrupt_column).alias("malformed_lines"))


def _with_corrupt(schema: T.StructType, corrupt_column: str | None) -> T.StructType:
    if not corrupt_column:
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType(), True)])


def read_headerless(spark: SparkSession, path: str | list[str], names: list[str],
                    sep: str = ",") -> DataFrame:
    """A file without header: positional fields named by the caller."""
    return read_delimited(spark, path, string_schema(names), header=False, sep=sep)


def read_pair_shared_header(spark: SparkSession, first: str, second: str, sep: str = ",") -> DataFrame:
    """Two files whose second has no header: it takes the first file's column names.

    Only the first line of the first file is read to learn the names; both
    files are then scanned once with the same all-string schema.
    """
    header_line = spark.read.text(first).limit(1).collect()
    names = _split_header(header_line[0].value, sep) if header_line else []
    schema = string_schema(names)
    a = read_delimited(spark, first, schema, header=True, sep=sep)
    b = read_delimited(spark, second, schema, header=False, sep=sep)
    return a.unionByName(b)


def _split_header(line: str, sep: str) -> list[str]:
    import csv
    return next(csv.reader([line], delimiter=sep))


def parse_csv_column(line: Column | str, schema: T.StructType | str, sep: str = ",",
                     null_value: str | None = None) -> Column:
    """Quote-aware parse of a CSV line held in a column -> struct."""
    opts = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    if null_value is not None:
        opts["nullValue"] = null_value
    ddl = schema if isinstance(schema, str) else _ddl(schema)
    c = F.col(line) if isinstance(line, str) else line
    return F.from_csv(c, ddl, opts)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# --- incident inputs -------------------------------------------------------------

def read_incident_csv(spark: SparkSession, path: str | list[str], corrupt_column: str | None = None) -> DataFrame:
    """Raw police incident CSV -> the analytic fields as text (snake_case names).

    With ``corrupt_column`` malformed rows are marked by their raw line (see :func:`split_malformed`).
    """
    raw = read_delimited(spark, path, INCIDENT_CSV_SCHEMA, header=True, corrupt_column=corrupt_column)
    return raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in INCIDENT_FIELDS.items()],
                      *([corrupt_column] if corrupt_column else []))


def read_zip_centroids(spark: SparkSession, path: str | list[str], corrupt_column: str | None = None,
                       line: str | None = "line") -> DataFrame:
    """``;``-delimited zip centroid file with a header; zip stays text.

    ``line`` is the row's place in the file (from 0, at any split size): ties of distance go by it.
    """
    rows = read_delimited(spark, path, ZIP_CENTROID_SCHEMA, header=True, sep=";", corrupt_column=corrupt_column)
    return with_line_numbers(rows, line) if line else rows


def parse_tagged_lines(lines: DataFrame, fields: list[str], line: str = "value") -> DataFrame:
    """Zip-tagged text ``(zip,<csv fields>)`` -> ``zip`` + named text fields.

    The outer brackets are stripped, the zip is the text before the first
    comma, and the remainder is parsed by the CSV parser (quotes honoured).
    """
    body = strip_brackets(line)
    cut = F.instr(body, ",")
    zip_col = F.when(cut > 0, F.substring(body, 1, cut - 1)).otherwise(body)
    rest = F.when(cut > 0, F.substr(body, cut + 1))
    parsed = F.from_csv(rest, ", ".join(f"`{f}` string" for f in fields),
                        {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return lines.select(zip_col.alias("zip"), parsed.alias("_f")).select(
        "zip", *[F.col("_f").getField(f).alias(f) for f in fields])


# --- fixed-width census files ------------------------------------------------------

def parse_fixed_width(lines: DataFrame, layout: dict[str, tuple[int, int]],
                      line: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Cut named fields out of fixed-width lines; layout is name -> (start, end), 0-based."""
    keep = keep or []
    return lines.select(*keep, *[fixed_slice(line, s, e).alias(n) for n, (s, e) in layout.items()])


def census_geo_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """Census geography records -> (logrecno, zcta5)."""
    return parse_fixed_width(lines, {"logrecno": CENSUS_GEO_LOGRECNO, "zcta5": CENSUS_GEO_ZCTA5}, line)


def census_segment_records(lines: DataFrame, line: str = "value",
                           segment: str = "segment") -> DataFrame:
    """Census segment records -> (logrecno, segment, payload)."""
    s, e = CENSUS_SEGMENT_LOGRECNO
    return lines.select(fixed_slice(line, s, e).alias("logrecno"), segment,
                        tail_from(line, CENSUS_SEGMENT_PAYLOAD_START).alias("payload"))


def read_numbered_segments(spark: SparkSession, path_glob: str,
                           number_pattern: str = r"ca(\d{5})\.") -> DataFrame:
    """All numbered segment files in one scan: ``value`` + ``segment`` number.

    The segment number is taken from each file's name through the hidden
    ``_metadata`` column, so 76 files are one job and one scan instead of 76.
    A file whose name has no number gets a NULL segment.
    """
    df = spark.read.text(path_glob)
    return df.select("value", F.regexp_extract(F.col("_metadata.file_name"), number_pattern, 1)
                     .try_cast("int").alias("segment"))
