"""Inference capture logs (S13, S14, B1) and vector helpers.

A capture line is JSON ``{captureData: {endpointInput: {encoding, data}}}``
whose ``data`` is the request body ``{ticker, features[]}``, base64 or
plain.  Malformed lines parse to NULL (PERMISSIVE ``from_json``,
``try_to_binary``) and are dropped, blank lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, StringType, StructField, StructType

from barsmith.sources.tables import read_table

CAPTURE_SCHEMA = StructType([
    StructField("captureData", StructType([
        StructField("endpointInput", StructType([
            StructField("encoding", StringType()),
            StructField("data", StringType()),
        ])),
    ])),
])
PAYLOAD_SCHEMA = StructType([
    StructField("ticker", StringType()),
    StructField("features", ArrayType(DoubleType())),
])

# Fixed values of the derived event views (FIXTURES part B).
EVENT_FEATURES = ["value", "k", "hour"]
BASELINE_END = "2024-01-21"      # baseline window: ts < this
LIVE_START = "2024-01-24"        # live window: ts >= this (last 7 days)
CORRUPT_MOD, CORRUPT_RES, BLANK_RES = 50, 7, 8


def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, ts, event_type, value, k, hour)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts", "event_type", F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"))


def capture_lines(spark: SparkSession, sf_dir: str, start: str | None = LIVE_START) -> DataFrame:
    """Capture log lines derived from ``events`` (``ts``, ``path``, ``value``).

    Odd event ids are base64 bodies, even ids plain JSON; one residue class
    is corrupted and another is a blank line, on purpose.
    """
    ev = event_features(spark, sf_dir)
    if start:
        ev = ev.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    body = F.to_json(F.struct(F.upper("event_type").alias("ticker"),
                              F.array("value", "k", "hour").alias("features")))
    odd = (F.col("event_id") % 2) == 1
    data = F.when(F.col("event_id") % CORRUPT_MOD == CORRUPT_RES, F.lit("corrupt")) \
        .when(odd, F.base64(F.encode(body, "UTF-8"))).otherwise(body)
    line = F.to_json(F.struct(F.struct(F.struct(
        F.when(odd, "BASE64").otherwise("JSON").alias("encoding"),
        data.alias("data")).alias("endpointInput")).alias("captureData")))
    line = F.when(F.col("event_id") % CORRUPT_MOD == BLANK_RES, F.lit("")).otherwise(line)
    path = F.concat(F.lit("captures/"), F.date_format("ts", "yyyy/MM/dd/HH"), F.lit("/part.jsonl"))
    return ev.select("event_id", "ts", path.alias("path"), line.alias("value"))


def decode_body(enc: Column, data: Column) -> Column:
    """B1: base64 (default when encoding is absent) or raw text."""
    b64 = F.coalesce(enc, F.lit("BASE64")) == "BASE64"
    # cast (not decode): bytes that are not UTF-8 must not fail the job;
    # from_json turns them into NULL like any other malformed body
    return F.when(b64, F.try_to_binary(data, F.lit("base64")).cast("string")).otherwise(data)


def parse_captures(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines -> (ticker, features) for well-formed, non-empty vectors.

    Other columns of ``lines`` are kept.
    """
    t = F.trim(F.col(col))
    rec = F.from_json(t, CAPTURE_SCHEMA)
    ei = rec["captureData"]["endpointInput"]
    payload = F.from_json(decode_body(ei["encoding"], ei["data"]), PAYLOAD_SCHEMA)
    keep = [c for c in lines.columns if c != col]
    out = lines.filter(t != "").select(*keep, payload.alias("_p"))
    return (out.select(*keep, F.col("_p.ticker").alias("ticker"), F.col("_p.features").alias("features"))
               .filter(F.col("features").isNotNull() & (F.size("features") > 0)))


def path_date(path: Column) -> Column:
    """Date from a ``/YYYY/MM/DD/`` path component (NULL if absent/invalid)."""
    m = F.regexp_extract(path, r"/(\d{4})/(\d{2})/(\d{2})/", 0)
    return F.try_to_date(F.nullif(F.regexp_replace(m, r"^/|/$", ""), F.lit("")), "yyyy/MM/dd")


def recent_files(lines: DataFrame, as_of: str, days: int, path_col: str = "path") -> DataFrame:
    """Keep rows whose path date >= as_of - days; undated paths kept."""
    d = path_date(F.col(path_col))
    return lines.filter(d.isNull() | (d >= F.date_sub(F.lit(as_of).cast("date"), days)))


DAY = "capture_day"


def write_dated(lines: DataFrame, root: str, path_col: str = "path") -> None:
    """Capture lines as Parquet in one folder a day (``capture_day=...``, from
    the path), lines of undated paths in the layout's NULL folder.  No shuffle:
    a day has at most one file of each task that holds its lines."""
    if DAY in lines.columns:
        raise ValueError(f"column {DAY!r} is the name of the layout")
    lines.withColumn(DAY, path_date(F.col(path_col))).write.mode("append").partitionBy(DAY).parquet(root)


def read_recent(spark: SparkSession, root: str, schema: StructType, as_of: str, days: int) -> DataFrame:
    """S14 over :func:`write_dated`: lines of the last ``days`` days before
    ``as_of`` and undated ones.  The condition is on the folders, so files of
    other days are neither opened nor listed for the scan."""
    d = F.col(DAY)
    read = spark.read.schema(StructType([*schema.fields, StructField(DAY, DateType())])).parquet(root)
    return read.filter(d.isNull() | (d >= F.date_sub(F.lit(as_of).cast("date"), days))).drop(DAY)


def read_capture_files(spark: SparkSession, path: str) -> DataFrame:
    """S13 file source: every ``*.jsonl`` under ``path`` (recursive), with
    the file path for date pruning."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl")
            .text(path).select("value", F.col("_metadata.file_path").alias("path")))


# ---------------------------------------------------------------------------
# R1-R3 vector helpers
# ---------------------------------------------------------------------------
def vector_problems(v: Column, n: int) -> Column:
    """Array of error strings (empty when the vector is valid)."""
    bad_len = F.when(F.size(v) != n, F.concat(F.lit(f"Expected {n} features, got "),
                                             F.size(v).cast("string")))
    idx = F.filter(
        F.transform(v, lambda x, i: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
                                           F.concat(F.lit("Feature["), i.cast("string"),
                                                    F.lit("] is not finite")))),
        lambda s: s.isNotNull())
    return F.when(v.isNull(), F.array(F.lit("features missing"))).otherwise(
        F.concat(F.array_compact(F.array(bad_len)), F.when(F.size(v) == n, idx).otherwise(F.array())))


def vector_is_valid(v: Column, n: int) -> Column:
    return v.isNotNull() & (F.size(v) == n) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def vector_to_long(df: DataFrame, vec: str, names: list[str], ids: list[str]) -> DataFrame:
    """(ids..., feature, value) by position; vectors of the wrong length
    are left out (route them with :func:`vector_problems`)."""
    name_arr = F.array(*[F.lit(n) for n in names])
    ok = df.filter(F.size(vec) == len(names))
    return ok.select(*ids, F.posexplode(vec).alias("_i", "value")) \
        .select(*ids, F.element_at(name_arr, F.col("_i") + 1).alias("feature"), "value")
