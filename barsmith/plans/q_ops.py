"""Queries: operational tables (A9, A11, A12, C2-C4, D2, F11-F13, J4, J6, J7,
K6, L10, S15-S17, T5, T7, U2, U3, W14, W15) on views derived from ``events``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barsmith.functions.dates import parse_model_version
from barsmith.operators import drift as D
from barsmith.operators import opslog as O
from barsmith.operators import splits as SP
from barsmith.operators.metrics import compute_metrics, naive_mean
from barsmith.operators.profile import to_long
from barsmith.params import DEFAULT_DRIFT as DP
from barsmith.plans import q_drift as QD
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, rounded, sql_round
from barsmith.sources import captures as C
from barsmith.sources.tables import read_table

REPORT_TS = "2024-01-30 06:00:00"      # the daily 06:00 UTC drift run
NEW_REPORT_TS = "2024-01-31 00:00:00"
DRIFT_TS = "2024-01-15 00:00:00"       # drift detected at (model staleness)


def latency_view(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "event_type", F.col("value").alias("latency_ms"))


# ---- A9 / W14 / W15 ---------------------------------------------------------------
@query("latency_summary", lambda: """
SELECT event_type, count(*) AS requests_total, """ + sql_round("avg(value)", 2) + """ AS avg_latency_ms,
  """ + sql_round("list_sort(list(value))[CAST(floor(count(*) * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1]", 2) +
       """ AS p95_latency_ms
FROM events GROUP BY event_type""")
def q_latency_summary(spark, sf_dir):
    return O.latency_summary(latency_view(spark, sf_dir), by=["event_type"])


def _bucket_sql():
    def at(p, cap=False):
        idx = f"CAST(floor(count(*) * CAST({p!r} AS DOUBLE)) AS BIGINT)"
        if cap:
            idx = f"least({idx}, count(*) - 1)"
        return sql_round(f"list_sort(list(value))[{idx} + 1]", 2)
    return f"""
SELECT date_trunc('minute', ts) AS bucket, {at(0.5)} AS p50_ms, {at(0.95)} AS p95_ms, {at(0.99, True)} AS p99_ms
FROM events GROUP BY 1 ORDER BY bucket DESC LIMIT 1440"""


@query("latency_buckets", _bucket_sql)
def q_latency_buckets(spark, sf_dir):
    """Per-minute p50/p95/p99, the newest 1440 buckets."""
    return O.latency_buckets(latency_view(spark, sf_dir))


def _trailing_sql():
    at = {"p50": "CAST(floor(len(l) * CAST(0.5 AS DOUBLE)) AS BIGINT)", "p95": "CAST(floor(len(l) * CAST(0.95 AS DOUBLE)) AS BIGINT)",
          "p99": "least(CAST(floor(len(l) * CAST(0.99 AS DOUBLE)) AS BIGINT), len(l) - 1)"}
    return "SELECT event_type, ts, event_id, " + ", ".join(f"{sql_round(f'list_sort(l)[{i} + 1]', 2)} AS {p}_ms" for p, i in at.items()) + """
FROM (SELECT event_type, ts, event_id, list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
                                                         ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS l FROM events)"""


@query("latency_trailing", _trailing_sql)
def q_latency_trailing(spark, sf_dir):
    """Percentiles over the newest 1000 requests of a type, at each request."""
    return O.latency_trailing(latency_view(spark, sf_dir))


@query("last_n_log", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
def q_last_n_log(spark, sf_dir):
    """The newest 1000 requests (the ring buffer's content)."""
    return O.last_n(read_table(spark, sf_dir, "events").select("event_id", "ts"), 1000)


# ---- A12 -----------------------------------------------------------------------------
@query("metric_alarm", """
SELECT date_trunc('hour', ts) AS period_start, """ + sql_round("max(value / 100.0)", 4) + """ AS max_value,
       max(value / 100.0) > 0.2 AS breaching
FROM events GROUP BY 1""")
def q_metric_alarm(spark, sf_dir):
    """Hourly MAX of a PSI-like metric (value / 100) vs 0.2."""
    ev = read_table(spark, sf_dir, "events")
    m = ev.select("ts", F.lit("Max_PSI").alias("name"), (F.col("value") / 100.0).alias("value"))
    return rounded(O.metric_alarm(m, name="Max_PSI", period_s=3600, threshold=0.2))


# ---- C2 / C3 / F11 ------------------------------------------------------------------------
JOB_SQL = f"""
  SELECT event_id, ts,
    CASE event_type WHEN 'click' THEN 'aws.events' WHEN 'signup' THEN 'manual' END AS source,
    CASE event_type WHEN 'error' THEN '{O.PROCESSING_EVENT}' WHEN 'purchase' THEN '{O.TRAINING_EVENT}' END AS detail_type,
    CASE WHEN event_type = 'error' THEN
           CASE event_id % 4 WHEN 0 THEN 'stock-ingest-' WHEN 1 THEN 'other-' ELSE 'drift-check-' END || event_id
         WHEN event_type = 'purchase' THEN 'stock-train-' || event_id END AS job_name
  FROM events"""

CLASS_SQL = f"""
  CASE WHEN source IS NOT NULL AND NOT starts_with(source, 'aws.') THEN source
       WHEN detail_type = '{O.PROCESSING_EVENT}' THEN
         CASE WHEN starts_with(coalesce(job_name, ''), '{O.DRIFT_JOB_PREFIX}') THEN 'drift_check_complete'
              WHEN starts_with(coalesce(job_name, ''), '{O.INGEST_JOB_PREFIX}') THEN 'ingestion_complete'
              ELSE 'unknown_processing_job:' || coalesce(job_name, '') END
       WHEN detail_type = '{O.TRAINING_EVENT}' THEN 'training_complete'
       ELSE 'scheduled' END"""


def job_events(spark, sf_dir, keep=(), ev=None):
    """Pipeline job events derived from ``events`` (five event shapes), batch
    or stream; ``keep`` names further columns to carry."""
    ev = read_table(spark, sf_dir, "events") if ev is None else ev
    et, eid = F.col("event_type"), F.col("event_id").cast("string")
    source = F.when(et == "click", "aws.events").when(et == "signup", "manual")
    dtype = F.when(et == "error", O.PROCESSING_EVENT).when(et == "purchase", O.TRAINING_EVENT)
    pre = F.when(F.col("event_id") % 4 == 0, "stock-ingest-").when(F.col("event_id") % 4 == 1, "other-") \
        .otherwise("drift-check-")
    job = F.when(et == "error", F.concat(pre, eid)).when(et == "purchase", F.concat(F.lit("stock-train-"), eid))
    return ev.select("event_id", "ts", source.alias("source"), dtype.alias("detail_type"), job.alias("job_name"), *keep)


def captures_exist(spark, sf_dir):
    """One row: is there any capture line (reads one at most)."""
    return C.capture_lines(spark, sf_dir).limit(1).agg((F.count(F.lit(1)) > 0).alias("captures_exist"))


@query("job_event_class", lambda: Q.cte(j=JOB_SQL) + f"SELECT event_id, {CLASS_SQL} AS kind FROM j")
def q_job_event_class(spark, sf_dir):
    j = job_events(spark, sf_dir)
    return j.select("event_id", O.classify_event(F.col("source"), F.col("detail_type"), F.col("job_name")).alias("kind"))


def _report_state_sql() -> dict:
    """CTEs: ``rep`` (the events drift report) and ``state`` (one row)."""
    c = QD.drift_ctes()
    c["rep"] = "SELECT * FROM (" + QD._report_select(f"SELECT count(*) FROM ef WHERE {QD.LIVE_WHERE}") + ")"
    c["j"] = JOB_SQL
    return c


def _fresh_sql(now: str) -> tuple[str, str]:
    age = f"((epoch({now}) - epoch(TIMESTAMP '{REPORT_TS}')) / 60.0)"
    return f"coalesce(rep.trigger_retraining AND {age} >= 0 AND NOT ({age} > {O.STALE_MINUTES}), false)", \
        f"({age} > {O.STALE_MINUTES})"


def _report_state(spark, sf_dir):
    rep = QD.q_drift_report(spark, sf_dir)          # one row
    return rep.select("trigger_retraining", "max_psi")


@query("report_staleness", lambda: Q.cte(**_report_state_sql()) + f"""
SELECT j.event_id, {_fresh_sql('j.ts')[0]} AS trigger_effective, {_fresh_sql('j.ts')[1]} AS stale,
       {R('rep.max_psi', 'max_psi')}
FROM j CROSS JOIN rep""")
def q_report_staleness(spark, sf_dir):
    """the report as seen at each event time: stale after 60 minutes
    (no retrain), max_psi kept."""
    st = F.broadcast(_report_state(spark, sf_dir))              # one row
    j = job_events(spark, sf_dir).crossJoin(st)
    trig, stale = O.report_freshness(F.col("ts"), F.lit(REPORT_TS).cast("timestamp_ntz"),
                                     F.col("trigger_retraining"))
    return rounded(j.select("event_id", trig.alias("trigger_effective"), stale.alias("stale"), "max_psi"))


@query("job_next_action", lambda: Q.cte(**_report_state_sql(), cap=QD.CAP, ef2=QD.EF) + f"""
SELECT j.event_id, {CLASS_SQL.replace('source', 'j.source').replace('detail_type', 'j.detail_type').replace('job_name', 'j.job_name')} AS kind,
  CASE ({CLASS_SQL.replace('source', 'j.source').replace('detail_type', 'j.detail_type').replace('job_name', 'j.job_name')})
    WHEN 'scheduled' THEN CASE WHEN (SELECT count(*) FROM cap) > 0 THEN 'drift_check_launched' ELSE 'skipped' END
    WHEN 'drift_check_complete' THEN CASE WHEN {_fresh_sql('j.ts')[0]} THEN 'ingestion_launched' ELSE 'no_drift' END
    WHEN 'ingestion_complete' THEN 'training_launched'
    WHEN 'training_complete' THEN 'updated'
    ELSE 'skipped' END AS action
FROM j CROSS JOIN rep""")
def q_job_next_action(spark, sf_dir):
    """Each job event -> the orchestrator's next action (a decision
    table joined with the latest report and whether captures exist)."""
    caps = captures_exist(spark, sf_dir)
    st = F.broadcast(_report_state(spark, sf_dir).crossJoin(caps))   # one row
    j = job_events(spark, sf_dir).crossJoin(st)
    kind = O.classify_event(F.col("source"), F.col("detail_type"), F.col("job_name"))
    trig, _ = O.report_freshness(F.col("ts"), F.lit(REPORT_TS).cast("timestamp_ntz"), F.col("trigger_retraining"))
    return j.select("event_id", kind.alias("kind"),
                    O.next_action(kind, F.col("captures_exist"), trig).alias("action"))


# ---- F12 -------------------------------------------------------------------------------
@query("model_stale", f"""
SELECT event_id, model_ts, model_ts < TIMESTAMP '{DRIFT_TS}' AS stale FROM (
  SELECT event_id, coalesce(try_strptime(regexp_replace(v, '^stock-model-', ''), '%Y%m%d-%H%M%S'),
                            TIMESTAMP '2000-01-01') AS model_ts
  FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'garbage-' || event_id
                              ELSE 'stock-model-' || strftime(ts, '%Y%m%d-%H%M%S') END AS v FROM events))""")
def q_model_stale(spark, sf_dir):
    """model version timestamp (unparsable -> 2000-01-01) older than the drift."""
    ev = read_table(spark, sf_dir, "events")
    v = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("garbage-"), F.col("event_id").cast("string"))) \
        .otherwise(F.concat(F.lit("stock-model-"), F.date_format("ts", "yyyyMMdd-HHmmss")))
    mt = parse_model_version(v).cast("timestamp_ntz")
    return ev.select("event_id", mt.alias("model_ts")).withColumn(
        "stale", F.col("model_ts") < F.lit(DRIFT_TS).cast("timestamp_ntz"))


# ---- F13 / C4 / D2 / U3 -------------------------------------------------------------------
LOG_SQL = f"""
  SELECT event_id AS seq, epoch_ms(ts) AS ts_ms,
    CASE event_type
      WHEN 'click' THEN 'Determined source: ' || ({CLASS_SQL})
      WHEN 'error' THEN '{{"status": "' || CASE WHEN event_id % 2 = 0 THEN 'no_drift' ELSE 'ingestion_launched' END || '", "max_psi": 0.1}}'
      WHEN 'purchase' THEN 'Training job Status: training_launched stock-train-' || event_id
      WHEN 'signup' THEN 'START RequestId: ' || event_id || ' Version: $LATEST'
      ELSE 'END RequestId: ' || event_id END AS message
  FROM (SELECT e.event_type, j.* FROM events e JOIN ({JOB_SQL}) j ON e.event_id = j.event_id)"""


def log_lines(spark, sf_dir):
    d = job_events(spark, sf_dir, keep=["event_type"])
    kind = O.classify_event(F.col("source"), F.col("detail_type"), F.col("job_name"))
    et, eid = F.col("event_type"), F.col("event_id").cast("string")
    msg = (F.when(et == "click", F.concat(F.lit("Determined source: "), kind))
            .when(et == "error", F.concat(F.lit('{"status": "'),
                                          F.when(F.col("event_id") % 2 == 0, "no_drift").otherwise("ingestion_launched"),
                                          F.lit('", "max_psi": 0.1}')))
            .when(et == "purchase", F.concat(F.lit("Training job Status: training_launched stock-train-"), eid))
            .when(et == "signup", F.concat(F.lit("START RequestId: "), eid, F.lit(" Version: $LATEST")))
            .otherwise(F.concat(F.lit("END RequestId: "), eid)))
    return d.select(F.col("event_id").alias("_seq"),
                    F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), msg.alias("message"))


@query("retrain_events", lambda: Q.cte(logs=LOG_SQL) + f"""
SELECT DISTINCT strftime(epoch_ms(ts_ms), '%Y-%m-%d %H:%M') || ' UTC' AS timestamp,
  CASE WHEN contains(m, '{O.SOURCE_MARK}') THEN trim(string_split(m, '{O.SOURCE_MARK}')[-1])
       ELSE substr(m, 1, 150) END AS event
FROM (SELECT ts_ms, arg_min(trim(message), seq) AS m FROM logs
      WHERE (contains(trim(message), '{O.SOURCE_MARK}') OR contains(lower(trim(message)), 'status'))
        AND ({' OR '.join(f"contains(trim(message), '{k}')" for k in O.LOG_KEYWORDS)})
      GROUP BY ts_ms)""")
def q_retrain_events(spark, sf_dir):
    return O.retrain_events(log_lines(spark, sf_dir))


# ---- ST2 batch twin, K6 / J4 / U2 / T7, A11 ----------------------------------------------
def windowed_drift(spark, sf_dir):
    """Drift per sliding 7-day window (1-day slide) over events after the
    baseline period: (features per window, report per window)."""
    ev = C.event_features(spark, sf_dir).filter(F.col("ts") >= F.lit(C.BASELINE_END).cast("timestamp_ntz"))
    w = ev.select(F.window("ts", "7 days", "1 day")["end"].alias("wend"), *C.EVENT_FEATURES)
    base = QD._baseline(spark, sf_dir)
    feats = D.drift_features(base, to_long(w, C.EVENT_FEATURES, ["wend"]), by=["wend"])
    n_live = w.groupBy("wend").agg(F.count(F.lit(1)).alias("n_live_samples"))
    n_base = base.agg(F.max("n_train_samples").alias("n_baseline_samples"))
    return feats, D.drift_report(feats, n_live, n_base, by=["wend"])


WIN_LONG = "\n  UNION ALL\n".join(
    f"  SELECT date_trunc('day', ts) - to_days(CAST(t.kk AS INTEGER)) + INTERVAL 7 DAY AS wend, '{f}' AS feature, {f} AS v "
    f"FROM ef, range(0, 7) t(kk) WHERE ts >= TIMESTAMP '{C.BASELINE_END}'" for f in C.EVENT_FEATURES)


def _win_ctes():
    c = QD.drift_ctes(live_long=WIN_LONG, keys=["wend"])
    c["nlive"] = f"""
  SELECT date_trunc('day', ts) - to_days(CAST(t.kk AS INTEGER)) + INTERVAL 7 DAY AS wend, count(*) AS n_live_samples
  FROM ef, range(0, 7) t(kk) WHERE ts >= TIMESTAMP '{C.BASELINE_END}' GROUP BY 1"""
    c["wrep"] = QD.report_rows_sql(["wend"], "nlive")
    return c


_HIST = ["timestamp", "max_psi", "drift_fraction", "n_features_drifted", "trigger_retraining"]


@query("drift_windows", lambda: Q.cte(**_win_ctes()) + "SELECT wend, " + ", ".join(
    R(c, c) if c in ("drift_fraction", "max_psi") else c for c in
    ["n_features_drifted", "drift_fraction", "max_psi", "overall_drift_detected", "trigger_retraining",
     "n_live_samples", "n_baseline_samples"]) + " FROM wrep")
def q_drift_windows(spark, sf_dir):
    """ST2 batch twin: one drift report per sliding 7-day window."""
    return rounded(windowed_drift(spark, sf_dir)[1])


def _hist_sql():
    c = _win_ctes()
    c["hist"] = "  SELECT wend AS timestamp, max_psi, drift_fraction, n_features_drifted, trigger_retraining FROM wrep"
    c["rep"] = "SELECT * FROM (" + QD._report_select(f"SELECT count(*) FROM ef WHERE {QD.LIVE_WHERE}") + ")"
    c["new"] = f"""
  SELECT TIMESTAMP '{NEW_REPORT_TS}' AS timestamp, max_psi, drift_fraction, n_features_drifted, trigger_retraining FROM rep
  UNION ALL SELECT TIMESTAMP '2024-01-25 00:00:00', 999.0, 1.0, 99, true"""
    sel = ", ".join(R(x, x) if x in ("max_psi", "drift_fraction") else x for x in _HIST)
    return Q.cte(**c) + f"""SELECT {sel} FROM (
  SELECT * FROM hist UNION ALL
  SELECT * FROM new WHERE timestamp NOT IN (SELECT timestamp FROM hist))"""


@query("drift_history_append", _hist_sql)
def q_drift_history_append(spark, sf_dir):
    """Drift history + new reports whose timestamp is not yet
    present (a duplicate timestamp is ignored), sorted by time (T7)."""
    _, wrep = windowed_drift(spark, sf_dir)
    hist = wrep.select(F.col("wend").alias("timestamp"), "max_psi", "drift_fraction",
                       "n_features_drifted", "trigger_retraining")
    rep = QD.q_drift_report(spark, sf_dir)
    new = rep.select(F.lit(NEW_REPORT_TS).cast("timestamp_ntz").alias("timestamp"), "max_psi", "drift_fraction",
                     "n_features_drifted", "trigger_retraining")
    dup = spark.createDataFrame([("2024-01-25 00:00:00", 999.0, 1.0, 99, True)],
                                "t string, max_psi double, drift_fraction double, n_features_drifted long, "
                                "trigger_retraining boolean") \
        .select(F.col("t").cast("timestamp_ntz").alias("timestamp"), "max_psi", "drift_fraction",
                "n_features_drifted", "trigger_retraining")
    return rounded(O.append_if_new(hist, new.unionByName(dup)).orderBy("timestamp"))


# the live windows of January 2024: seven-day windows that end on these days
WINDOW_ENDS = [f"2024-01-{d:02d}" for d in range(22, 32)] + [f"2024-02-{d:02d}" for d in range(1, 7)]


@query("ks_pivot", lambda: Q.cte(**_win_ctes()) + "SELECT feature, " + ", ".join(
    f"avg(CASE WHEN strftime(wend, '%Y-%m-%d') = '{d}' THEN " + sql_round("ks_statistic", 6) + f' END) AS "{d}"' for d in WINDOW_ENDS) +
       " FROM drift GROUP BY feature")
def q_ks_pivot(spark, sf_dir):
    """Feature x window, mean KS statistic; a window outside
    ``WINDOW_ENDS`` is an error, not left out."""
    feats, _ = windowed_drift(spark, sf_dir)
    day = F.date_format("wend", "yyyy-MM-dd")
    listed = F.when(day.isin(WINDOW_ENDS), day).otherwise(F.raise_error(F.concat(F.lit("window outside the listed period: "), day)))
    p = feats.select("feature", listed.alias("d"), "ks_statistic") \
        .groupBy("feature").pivot("d", WINDOW_ENDS).avg("ks_statistic")
    return rounded(p)


# ---- S15 / S16 / S17 ------------------------------------------------------------------------
@query("drift_metrics_long", lambda: Q.cte(**_report_state_sql()) + f"""
SELECT TIMESTAMP '{REPORT_TS}' AS ts, name, dims, {sql_round('value', 4)} AS value, unit FROM (
  SELECT 'Overall_Drift_Score' AS name, MAP {{'Ticker': 'ALL'}} AS dims, CAST(drift_fraction AS DOUBLE) AS value, 'None' AS unit FROM rep
  UNION ALL SELECT 'Max_PSI', MAP {{'Ticker': 'ALL'}}, max_psi, 'None' FROM rep
  UNION ALL SELECT 'Drift_Triggered', MAP {{'Ticker': 'ALL'}}, CAST(overall_drift_detected AS DOUBLE), 'None' FROM rep
  UNION ALL SELECT 'Retrain_Triggered', MAP {{'Ticker': 'ALL'}}, CAST(trigger_retraining AS DOUBLE), 'None' FROM rep
  UNION ALL SELECT 'N_Features_Drifted', MAP {{'Ticker': 'ALL'}}, CAST(n_features_drifted AS DOUBLE), 'Count' FROM rep
  UNION ALL SELECT 'Live_Sample_Count', MAP {{'Ticker': 'ALL'}}, CAST(n_live_samples AS DOUBLE), 'Count' FROM rep
  UNION ALL SELECT 'Feature_PSI', MAP {{'Ticker': 'ALL', 'Feature': feature}}, psi, 'None' FROM drift
  UNION ALL SELECT 'Feature_KS_Statistic', MAP {{'Ticker': 'ALL', 'Feature': feature}}, ks_statistic, 'None' FROM drift)""")
def q_drift_metrics_long(spark, sf_dir):
    """Report -> metric rows (6 report-level + 2 per feature)."""
    base = QD._baseline(spark, sf_dir)
    live = QD._event_live(spark, sf_dir)
    feats = D.drift_features(base, to_long(live, C.EVENT_FEATURES))
    n_live = live.agg(F.count(F.lit(1)).alias("n_live_samples"))
    n_base = base.agg(F.max("n_train_samples").alias("n_baseline_samples"))
    rep = D.drift_report(feats, n_live, n_base)
    return rounded(O.drift_metrics_long(rep, feats, ts=F.lit(REPORT_TS).cast("timestamp_ntz")))


@query("drift_report_json")
def q_drift_report_json(spark, sf_dir):
    """The report document (header + per-feature structs) as JSON."""
    base = QD._baseline(spark, sf_dir)
    live = QD._event_live(spark, sf_dir)
    feats = D.drift_features(base, to_long(live, C.EVENT_FEATURES))
    n_live = live.agg(F.count(F.lit(1)).alias("n_live_samples"))
    n_base = base.agg(F.max("n_train_samples").alias("n_baseline_samples"))
    rep = D.drift_report(feats, n_live, n_base)
    return D.report_json(rep, feats, F.lit(REPORT_TS))


def _eval_frame(spark, sf_dir):
    from barsmith.plans.q_splits import _fm
    d = SP.three_way_split(_fm(spark, sf_dir))
    nm = naive_mean(d.filter(F.col("split") == "train"))
    return d, nm


def _model_metrics_sql():
    from barsmith.plans.q_splits import _g_ctes, _metric_sql, _r
    c = _g_ctes({
        "nm": "  SELECT avg(target) AS prediction FROM g3 WHERE split = 'train'",
        "mt": "  SELECT split, " + _metric_sql("target", "prediction", _r) +
              " FROM g3, nm WHERE split IN ('val', 'test') GROUP BY split"})
    return Q.cte(**c) + f"""
SELECT TIMESTAMP '{REPORT_TS}' AS ts, MAP {{'Ticker': 'ALL', 'ModelVersion': 'naive-mean-' || split}} AS dims,
       name, {sql_round('value', 4)} AS value, 'None' AS unit FROM (
  SELECT split, 'Model_RMSE' AS name, rmse AS value FROM mt UNION ALL SELECT split, 'Model_MAE', mae FROM mt
  UNION ALL SELECT split, 'Directional_Accuracy', directional_accuracy FROM mt)"""


@query("model_metrics_long", _model_metrics_sql)
def q_model_metrics_long(spark, sf_dir):
    """Model metrics as (Ticker, ModelVersion)-dimensioned rows."""
    d, nm = _eval_frame(spark, sf_dir)
    scored = d.filter(F.col("split").isin("val", "test")).crossJoin(F.broadcast(nm))
    m = compute_metrics(scored, by=["split"])
    out = O.model_metrics_long(m, F.lit("ALL"), F.concat(F.lit("naive-mean-"), F.col("split")),
                               ts=F.lit(REPORT_TS).cast("timestamp_ntz"))
    return rounded(out)


# ---- J7 / L10 / J6 --------------------------------------------------------------------------------
def _cv_fold_metrics(spark, sf_dir):
    from barsmith.plans.q_splits import _fm
    tv = SP.three_way_split(_fm(spark, sf_dir)).filter(F.col("split") != "test").drop("split")
    folds = SP.walk_forward_folds(tv)
    means = folds.filter(F.col("role") == "train").groupBy("fold").agg(F.avg("target").alias("prediction"))
    val = folds.filter(F.col("role") == "val").join(F.broadcast(means), "fold")
    return compute_metrics(val, by=["fold"])


def _rmse_delta_sql():
    from barsmith.plans.q_splits import _cv_sql
    return _cv_sql().split("SELECT 'naive_mean' AS model")[0] + """
SELECT fold, lag(rmse) OVER (ORDER BY fold) AS before_rmse, rmse AS after_rmse,
       """ + sql_round("rmse - lag(rmse) OVER (ORDER BY fold)", 6) + """ AS rmse_delta FROM fold_m"""


@query("retrain_rmse_delta", _rmse_delta_sql)
def q_retrain_rmse_delta(spark, sf_dir):
    """Each walk-forward refit as a retraining run; delta to the previous run."""
    fm = _cv_fold_metrics(spark, sf_dir).select("fold", "rmse")
    w = Window.orderBy("fold")               # one row per fold (3 rows)
    prev = F.lag("rmse").over(w)
    return rounded(fm.select("fold", prev.alias("before_rmse"), F.col("rmse").alias("after_rmse"),
                             (F.col("rmse") - prev).alias("rmse_delta")))


def _compare_sql():
    from barsmith.plans.q_splits import _g_ctes, _metric_sql, _r
    c = _g_ctes({"nm": "  SELECT avg(target) AS prediction FROM g3 WHERE split = 'train'"})
    body = " UNION ALL ".join([
        "SELECT 'naive_mean' AS model, " + _metric_sql("target", "nm.prediction", _r) +
        " FROM g3, nm WHERE split = 'test'",
        "SELECT 'zero' AS model, " + _metric_sql("target", "0.0", _r) + " FROM g3 WHERE split = 'test'",
        "SELECT 'last_return' AS model, " + _metric_sql("target", "returns_1d", _r) + " FROM g3 WHERE split = 'test'",
    ])
    return Q.cte(**c) + body


@query("model_compare", _compare_sql)
def q_model_compare(spark, sf_dir):
    """The same hold-out scored by several simple models, one row
    per model (rows unioned by name)."""
    d, nm = _eval_frame(spark, sf_dir)
    test = d.filter(F.col("split") == "test")
    naive = compute_metrics(test.crossJoin(F.broadcast(nm))).withColumn("model", F.lit("naive_mean"))
    zero = compute_metrics(test.withColumn("prediction", F.lit(0.0))).withColumn("model", F.lit("zero"))
    last = compute_metrics(test.withColumn("prediction", F.col("returns_1d"))).withColumn("model", F.lit("last_return"))
    return naive.unionByName(zero, allowMissingColumns=True).unionByName(last, allowMissingColumns=True)
