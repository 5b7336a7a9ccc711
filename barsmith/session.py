"""Session helpers.

The engine never creates cluster-wide state on its own: it reads the
checkpoint folder the cluster names in ``spark.checkpoint.dir`` and only
falls back to a fresh scratch folder when the setting is absent (tests,
local runs).
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the engine relies on (all runtime-settable SQL confs).
_RUNTIME_CONF = {
    # The reference uses tz-naive / UTC timestamps throughout.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators assume; idempotent."""
    for k, v in _RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "barsmith") -> SparkSession:
    """Session for tests / local runs.  On a cluster, use the provided one."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BARSMITH_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no Python call-site capture per Column call (a debugging aid that
        # costs ~1 ms per functions.* call while building large plans)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in _RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints / intermediate tables.

    Read from ``spark.checkpoint.dir``; where it is unset, a local session
    (tests) gets a new scratch folder and any other master an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="barsmith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df, name: str = "table"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a recomputation after an executor loss starts
    here) and lets several jobs reuse one result."""
    import uuid

    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def bucketed(df, column: str, buckets: int, name: str = "table"):
    """Like `materialize`, but as a table bucketed by ``column``, so that joins
    on it do not shuffle it again; the catalog forgets it at the end."""
    import uuid

    spark = df.sparkSession
    table = f"{name}-{uuid.uuid4().hex[:12]}".replace("-", "_")
    df.write.bucketBy(buckets, column).option("path", os.path.join(checkpoint_dir(spark), table)).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
