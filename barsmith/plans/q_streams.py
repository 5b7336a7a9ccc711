"""Queries: Structured Streaming twins (ST1-ST10).

Each builder runs a real streaming query (availableNow) and returns the
resulting table; the oracle SQL is the batch twin's."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from barsmith.operators import drift as D
from barsmith.operators import opslog as O
from barsmith.operators.profile import to_long
from barsmith.plans import q_drift as QD
from barsmith.plans import q_ops as QO
from barsmith.plans import sql as Q
from barsmith.plans.registry import _REGISTRY, R, query, rounded, round_col
from barsmith.sources import captures as C
from barsmith.session import materialize
from barsmith.streaming.streams import last_n_stream, run_to_table, table_stream


def _events(spark, sf_dir):
    """The events table as a file stream; ``ts`` as TIMESTAMP (watermarks
    need it; the session time zone is UTC so wall-clock values are kept)."""
    return table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _ntz(c):
    return F.col(c).cast("timestamp_ntz")


# ---- ST1 capture file stream --------------------------------------------------------
@query("stream_capture_parse", lambda: Q.cte(**QD._capture_ctes()) +
       "SELECT ticker, list_transform(features, lambda x: " + QD.sql_round("x", 6) + ") AS features FROM parsed")
def q_stream_capture_parse(spark, sf_dir):
    """Capture JSONL files under dated folders -> text stream -> parsed vectors."""
    from barsmith.streaming.streams import _scratch
    root = _scratch(spark, "captures")
    lines = C.capture_lines(spark, sf_dir).select(
        "value", F.date_format("ts", "yyyy").alias("y"), F.date_format("ts", "MM").alias("m"),
        F.date_format("ts", "dd").alias("d"))
    lines.write.mode("overwrite").partitionBy("y", "m", "d").text(root)      # landed per day
    stream = (spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", 4)
              .schema("value string").text(root).select("value"))
    parsed = C.parse_captures(stream).select("ticker", "features")
    out = run_to_table(parsed, "capture-parse")
    return out.select("ticker", F.transform("features", lambda x: round_col(x, 6)).alias("features"))


# ---- ST2 / ST9 sliding-window drift ---------------------------------------------------
@query("stream_drift_window", lambda: QD.Q.cte(**QO._win_ctes()) + "SELECT wend, " + ", ".join(
    R(c, c) if c in ("drift_fraction", "max_psi") else c for c in
    ["n_features_drifted", "drift_fraction", "max_psi", "overall_drift_detected", "trigger_retraining",
     "n_live_samples", "n_baseline_samples"]) + " FROM wrep")
def q_stream_drift_window(spark, sf_dir):
    """Live-side drift counts as a streaming aggregation per 7-day window
    (1-day slide, watermark 1 day for late rows); KS / PSI are finalised
    from the counts."""
    base = QD._baseline(spark, sf_dir)
    # one row per feature: materialised so the stream joins a plain table
    ref = materialize(D.drift_reference(base), "drift-ref")
    ev = _events(spark, sf_dir).filter(F.col("ts") >= F.lit(C.BASELINE_END).cast("timestamp"))
    ev = ev.withWatermark("ts", "1 day").select(
        F.window("ts", "7 days", "1 day")["end"].alias("wend"), "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"), F.hour("ts").cast("double").alias("hour"))
    long = to_long(ev, C.EVENT_FEATURES, ["wend"])
    keys = ["wend", "feature", "j", "eq", "b"]
    slots = run_to_table(D.live_slot_counts(ref, long, by=["wend"]), "drift-slots", mode="update", keys=keys)
    counts = run_to_table(ev.groupBy("wend").agg(F.count(F.lit(1)).alias("n_live_samples")),
                          "drift-counts", mode="update", keys=["wend"])
    feats = D.drift_from_slots(slots, ref, by=["wend"])
    n_base = base.agg(F.max("n_train_samples").alias("n_baseline_samples"))
    rep = D.drift_report(feats, counts, n_base, by=["wend"])
    return rounded(rep.withColumn("wend", _ntz("wend")))


# ---- ST3 latency buckets ------------------------------------------------------------------
@query("stream_latency_buckets", QO._bucket_sql)
def q_stream_latency_buckets(spark, sf_dir):
    """Tumbling 1-minute buckets with exact rank percentiles.  The state is a
    count for each (bucket, value), mergeable and evicted by the 1-minute
    watermark; ranks are taken from the counts, so a busy minute is no row."""
    ev = _events(spark, sf_dir).withWatermark("ts", "1 minute")
    counts = ev.groupBy(F.window("ts", "1 minute"), "value").count().select(F.col("window.start").alias("bucket"), "value", F.col("count").alias("n"))
    return O.buckets_of_counts(run_to_table(counts, "latency", mode="update", keys=["bucket", "value"]).withColumn("bucket", _ntz("bucket")))


# ---- ST4 last-N state -----------------------------------------------------------------------
@query("stream_last_n", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
def q_stream_last_n(spark, sf_dir):
    """Custom stateful operator: capped per-key buffers, merged to the newest 1000."""
    buf = run_to_table(last_n_stream(_events(spark, sf_dir)), "last-n", mode="update")
    # every row that was ever among its bucket's newest 1000 was emitted once;
    # the global newest 1000 of that union are the newest 1000 overall
    newest = buf.dropDuplicates(["event_id"])
    return O.last_n(newest.select("event_id", F.timestamp_micros("ts_us").cast("timestamp_ntz").alias("ts")), 1000)


# ---- ST5 running counter ----------------------------------------------------------------------
@query("stream_request_count", "SELECT event_type, count(*) AS requests_total FROM events GROUP BY event_type")
def q_stream_request_count(spark, sf_dir):
    c = _events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("requests_total"))
    return run_to_table(c, "requests", mode="update", keys=["event_type"])


# ---- ST6 alarm ------------------------------------------------------------------------------------
@query("stream_alarm", """
SELECT date_trunc('hour', ts) AS period_start, """ + QD.sql_round("max(value / 100.0)", 4) + """ AS max_value,
       max(value / 100.0) > 0.2 AS breaching
FROM events GROUP BY 1""")
def q_stream_alarm(spark, sf_dir):
    """A12 on a stream: hourly max with a watermark; missing hours = OK."""
    ev = _events(spark, sf_dir).withWatermark("ts", "1 hour")
    m = ev.select("ts", F.lit("Max_PSI").alias("name"), (F.col("value") / 100.0).alias("value"))
    a = O.metric_alarm(m, name="Max_PSI", period_s=3600, threshold=0.2)
    out = run_to_table(a, "alarm", mode="update", keys=["period_start"])
    return rounded(out.withColumn("period_start", _ntz("period_start")))


# ---- ST7 job decisions ------------------------------------------------------------------------------
@query("stream_job_actions", lambda: _REGISTRY["job_next_action"][1]())
def q_stream_job_actions(spark, sf_dir):
    """Stream-static join of job events with the latest report (one row)."""
    caps = QO.captures_exist(spark, sf_dir)
    # one row, materialised so the stream joins a plain table
    state = F.broadcast(materialize(QO._report_state(spark, sf_dir).crossJoin(caps), "job-state"))
    j = QO.job_events(spark, sf_dir, ev=_events(spark, sf_dir)).crossJoin(state)
    kind = O.classify_event(F.col("source"), F.col("detail_type"), F.col("job_name"))
    trig, _ = O.report_freshness(F.col("ts"), F.lit(QO.REPORT_TS).cast("timestamp"), F.col("trigger_retraining"))
    s = j.select("event_id", kind.alias("kind"), O.next_action(kind, F.col("captures_exist"), trig).alias("action"))
    return run_to_table(s, "job-actions")


# ---- ST8 scoring ---------------------------------------------------------------------------------------
@query("stream_score")
def q_stream_score(spark, sf_dir):
    """A fitted Spark ML pipeline applied to a stream of feature rows."""
    from barsmith.operators.models import fit_linear
    from barsmith.plans.q_splits import _fm
    from barsmith.streaming.streams import _scratch
    from barsmith.operators import splits as SP
    fm = _fm(spark, sf_dir)
    model = fit_linear(SP.three_way_split(fm).filter(F.col("split") == "train"))
    path = _scratch(spark, "score-input")
    fm.write.mode("overwrite").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    scored = model.transform(stream).select("ticker", "date", "prediction")
    return run_to_table(scored, "score")


# ---- ST10 idempotent de-duplication ---------------------------------------------------------------------
@query("stream_dedup", "SELECT DISTINCT date_trunc('minute', ts) AS minute FROM events")
def q_stream_dedup(spark, sf_dir):
    """One row per minute key within the watermark (dropDuplicatesWithinWatermark)."""
    ev = _events(spark, sf_dir).withWatermark("ts", "1 hour") \
        .select(F.date_trunc("minute", "ts").alias("minute"), "ts")
    d = ev.dropDuplicatesWithinWatermark(["minute"]).select(_ntz("minute").alias("minute"))
    return run_to_table(d, "dedup")
