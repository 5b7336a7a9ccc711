"""Structured Streaming twins (ST1-ST10).

Every stream runs with ``trigger(availableNow=True)`` (the reference's
daily job = "process what has arrived, then stop"), keeps its checkpoint in
the shared checkpoint directory and writes each micro-batch to parquet
through ``foreachBatch`` tagged with the batch id.  For update-mode
aggregations the table view keeps, per key, the row of the latest batch —
so a re-run batch after a failure (same id) is idempotent.
"""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from barsmith.session import checkpoint_dir
from barsmith.sources.tables import read_table

BATCH = "_batch"


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex[:12]}")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A file stream over one of the driver's parquet tables."""
    schema = read_table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir))


def run_to_table(sdf: DataFrame, name: str, *, mode: str = "append", keys=None) -> DataFrame:
    """Run ``sdf`` to completion (availableNow) and return the result table.

    ``keys``: for ``update`` mode, the row of the latest batch per key.
    """
    spark = sdf.sparkSession
    root = _scratch(spark, name)
    out, ckpt = os.path.join(root, "data"), os.path.join(root, "checkpoint")

    written: set[int] = set()

    def sink(batch: DataFrame, batch_id: int) -> None:
        # the batch's own folder: a replay overwrites what it wrote before
        (batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
              .write.mode("overwrite").parquet(os.path.join(out, f"{BATCH}={batch_id}")))
        written.add(batch_id)

    q = (sdf.writeStream.outputMode(mode).foreachBatch(sink)
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    if not written:
        return spark.createDataFrame([], sdf.schema)
    res = spark.read.parquet(os.path.join(out, f"{BATCH}=*"))
    cols = [c for c in res.columns if c != BATCH]
    if keys:
        rest = [c for c in cols if c not in keys]
        latest = F.max_by(F.struct(*rest), F.col(BATCH))
        return res.groupBy(*keys).agg(latest.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
    return res.select(*cols)


# ---------------------------------------------------------------------------
# ST4: keyed, capped ring buffer (custom state)
# ---------------------------------------------------------------------------
def last_n_stream(events: DataFrame, n: int = 1000, salts: int = 16) -> DataFrame:
    """Per (event_type, salt) keep the newest ``n`` (ts, event_id) in state.

    The newest ``n`` of the whole stream are contained in the union of the
    per-bucket newest ``n`` (exact); salting spreads a hot event type over
    ``salts`` buckets.  State per bucket is capped at ``n`` rows.
    """
    d = events.select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
                      (F.abs(F.xxhash64("event_id")) % salts).alias("salt"))
    out_schema = "event_type string, salt long, event_id long, ts_us long"
    state_schema = "ids array<long>, ts_us array<long>"

    def keep_newest(key, pdfs, state):
        ids, tss = ([], []) if not state.exists else (list(state.get[0]), list(state.get[1]))
        buf = pd.DataFrame({"event_id": ids, "ts_us": tss})
        for pdf in pdfs:  # cut back to n after every chunk
            buf = pd.concat([buf, pdf[["event_id", "ts_us"]]]).sort_values(["ts_us", "event_id"], ascending=False).head(n)
        state.update((buf["event_id"].tolist(), buf["ts_us"].tolist()))
        yield pd.DataFrame({"event_type": key[0], "salt": key[1],
                            "event_id": buf["event_id"].astype("int64"), "ts_us": buf["ts_us"].astype("int64")})

    return d.groupBy("event_type", "salt").applyInPandasWithState(
        keep_newest, out_schema, state_schema, "update", GroupStateTimeout.NoTimeout)


__all__ = ["table_stream", "run_to_table", "last_n_stream"]
