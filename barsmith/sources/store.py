"""Feature store on parquet (S6, S8-S12) and the vendor JSON source.

Layout: ``<root>/ticker=<t>/date_tag=<yyyymmdd>/part-*.parquet`` —
partition columns replace the reference's one-file-per-ticker keys, so a
single-ticker read is partition pruning and "latest version" is a max
over a partition column.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from barsmith.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def write_features(df: DataFrame, path: str, *, by=("ticker",), mode: str = "overwrite") -> None:
    """Partitioned parquet; dynamic partition overwrite so a new
    version tag replaces only its own partitions."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def read_panel(spark: SparkSession, path: str, require: str | None = "target") -> DataFrame:
    """Every partition, schemas merged by name; files in which ``require``
    is missing (or never filled) are left out."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    if not require:
        return df
    if require not in df.columns:
        raise ValueError(f"no file under {path} has column {require!r}")
    named = df.withColumn("_file", F.col("_metadata.file_path"))
    files = named.groupBy("_file").agg(F.count(require).alias("_n")).filter("_n > 0").select("_file")
    return named.join(files, "_file", "left_semi").drop("_file")


def read_ticker(spark: SparkSession, path: str, ticker: str) -> DataFrame:
    """One ticker — a partition filter, pruned at planning time."""
    return spark.read.parquet(path).filter(F.col("ticker") == ticker)


def latest_version(df: DataFrame, by: str = "ticker", tag: str = "date_tag") -> DataFrame:
    """Rows of the newest ``date_tag`` per ticker (max + semi-join on
    the tiny (ticker, tag) table; no sort of the data)."""
    tags = df.select(by, tag).distinct()
    newest = tags.groupBy(by).agg(F.max(tag).alias(tag))
    return df.join(newest, [by, tag], "left_semi")


# --------------------------------------------------------------------------
# S4 / S5 vendor time-series JSON
# --------------------------------------------------------------------------
SERIES_KEY = "Time Series (Daily)"
# The vendor's field names.
VENDOR_FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low",
                 "close": "5. adjusted close", "volume": "6. volume"}
_SERIES_TYPE = MapType(StringType(), MapType(StringType(), StringType()))


def flatten_series(docs: DataFrame, col: str = "value", keep=("ticker",)) -> DataFrame:
    """Vendor document -> bars (close = adjusted close).  Documents
    without the series key produce no rows (see :func:`series_rejects`)."""
    series = F.from_json(F.get_json_object(F.col(col), f"$['{SERIES_KEY}']"), _SERIES_TYPE)
    d = docs.select(*keep, F.explode(series).alias("_d", "_v"))
    out = [F.to_date("_d").alias("date")]
    for k, field in VENDOR_FIELDS.items():
        out.append(F.try_element_at(F.col("_v"), F.lit(field)).try_cast("double").alias(k))
    return d.select(*keep, *out)


def series_rejects(docs: DataFrame, col: str = "value", keep=("ticker",)) -> DataFrame:
    """Rate-limit notes / error messages / missing series -> rejects."""
    note = F.get_json_object(F.col(col), "$.Note")
    err = F.get_json_object(F.col(col), "$['Error Message']")
    has = F.get_json_object(F.col(col), f"$['{SERIES_KEY}']").isNotNull()
    reason = (F.when(note.isNotNull(), "rate_limited")
               .when(err.isNotNull(), "error")
               .when(~has, "missing_series"))
    return docs.select(*keep, reason.alias("reason")).filter(F.col("reason").isNotNull())


def vendor_documents(bars: DataFrame) -> DataFrame:
    """Vendor-style JSON pages built from bars: one document per (ticker,
    month) — bounded size — with some rate-limit / error pages on purpose.
    ``4. close`` holds the unadjusted value (the high here) on purpose."""
    s = lambda c: F.col(c).cast("string")
    entry = F.create_map(
        F.lit("1. open"), s("open"), F.lit("2. high"), s("high"), F.lit("3. low"), s("low"),
        F.lit("4. close"), s("high"), F.lit("5. adjusted close"), s("close"),
        F.lit("6. volume"), s("volume"))
    pages = bars.groupBy("ticker", F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), entry)))
        .alias("_series"))
    mi = F.year(F.to_date("month", "yyyy-MM")) * 12 + F.month(F.to_date("month", "yyyy-MM"))
    mi = F.when(mi % 7 == 3, 3).when(mi % 11 == 5, 5).otherwise(0)
    doc = (F.when(mi == 3, F.to_json(F.struct(F.lit("Thank you for using our API; rate limit").alias("Note"))))
            .when(mi == 5, F.to_json(F.struct(F.lit("Invalid API call").alias("Error Message"))))
            .otherwise(F.to_json(F.struct(F.col("_series").alias(SERIES_KEY)))))
    return pages.select("ticker", "month", doc.alias("value"))
