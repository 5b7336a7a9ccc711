"""Reading the driver's parquet tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from barsmith.session import prepare

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; column pruning / filter pushdown are left to Catalyst."""
    prepare(spark)
    return spark.read.parquet(table_path(sf_dir, name))
