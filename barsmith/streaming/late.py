"""Late rows of a stream as a table (ST9)."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from barsmith.streaming.streams import BATCH, _scratch

_STATS = "n_rows long, n_late long, n_undated long, high_us long"


def late_rows(sdf: DataFrame, ts: str, delay_s: int, window_s: int = 0, *, name: str = "late", root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Runs ``sdf`` over what has arrived and returns (late rows, batches).

    A row of a batch is late when the end of its tumbling window of ``window_s``
    seconds (with 0: its ``ts``) is not after the largest ``ts`` of all earlier
    batches less ``delay_s`` seconds, in whole milliseconds like a watermark.
    Spark's stateful operators may use the bound of one batch before, so what
    they drop is always among these rows.  Rows without ``ts`` are counted as
    undated and never late; the first batch has no late rows.

    Late rows keep all their columns and get ``_batch``; batches has n_rows,
    n_late, n_undated and high_us (largest ts, microseconds) a batch.  Both are
    folders per batch under ``root``: a replayed batch overwrites its own, and
    a later run with the same ``root`` goes on where this one ended.
    """
    spark = sdf.sparkSession
    root = root or _scratch(spark, name)
    late_dir, stat_dir = os.path.join(root, "late"), os.path.join(root, "batches")
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    end = us - F.pmod(us, F.lit(window_s * 1_000_000)) + F.lit(window_s * 1_000_000) if window_s else us

    def batches(s):
        return s.read.schema(f"{_STATS}, {BATCH} long").parquet(stat_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        # one row a batch; the first batch has no earlier one to read
        high = batches(s).filter(F.col(BATCH) < batch_id).agg(F.max("high_us")).first()[0] if batch_id else None
        bound = F.lit(None).cast("long") if high is None else F.lit(high // 1000 * 1000 - delay_s * 1_000_000)
        is_late = F.coalesce(end <= bound, F.lit(False))
        batch.filter(is_late).write.mode("overwrite").parquet(os.path.join(late_dir, f"{BATCH}={batch_id}"))
        stats = batch.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(is_late).alias("n_late"),
                          F.count_if(F.col(ts).isNull()).alias("n_undated"), F.max(us).alias("high_us"))
        stats.write.mode("overwrite").parquet(os.path.join(stat_dir, f"{BATCH}={batch_id}"))

    q = (sdf.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(root, "checkpoint"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    try:
        return spark.read.schema(StructType([*sdf.schema.fields, StructField(BATCH, LongType())])).parquet(late_dir), batches(spark)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # nothing has arrived yet
        empty = spark.createDataFrame([], sdf.schema)
        return empty.withColumn(BATCH, F.lit(0).cast("long")), spark.createDataFrame([], f"{_STATS}, {BATCH} long")
