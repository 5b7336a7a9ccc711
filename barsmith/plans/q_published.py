"""Queries: published results (S15, S18) and late rows (ST9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barsmith.plans import q_backtest as QB
from barsmith.plans import q_ops as QO
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, round_col, rounded, sql_round
from barsmith.session import materialize
from barsmith.sources import captures as C
from barsmith.sources import snapshots as SN
from barsmith.sources.store import scratch_path
from barsmith.sources.tables import read_table
from barsmith.streaming.late import late_rows
from barsmith.streaming.streams import BATCH

_REP = ["n_features_drifted", "drift_fraction", "max_psi", "overall_drift_detected", "trigger_retraining",
        "n_live_samples", "n_baseline_samples"]


# ---- S15 report table ---------------------------------------------------------------
def _rep_sql(where: str = "") -> str:
    cols = ", ".join(R(c, c) if c in ("drift_fraction", "max_psi") else c for c in _REP)
    return Q.cte(**QO._win_ctes()) + f"SELECT wend, {cols} FROM wrep {where}"


def _report_table(spark, sf_dir):
    """Two monitoring runs publish the reports of their windows; the first is
    replayed after the second and adds nothing."""
    rep = materialize(QO.windowed_drift(spark, sf_dir)[1], "reports")
    root = scratch_path(spark, "report-table")
    cut = F.col("wend") < F.date_add(F.lit(C.BASELINE_END).cast("date"), 7)
    runs = {"run-1": rep.filter(cut), "run-2": rep.filter(~cut)}
    for run in ("run-1", "run-2", "run-1"):
        SN.publish(runs[run], root, run)
    return SN.read_all(spark, root).select("wend", *_REP)


@query("drift_report_table", _rep_sql)
def q_drift_report_table(spark, sf_dir):
    """All published window reports."""
    return rounded(_report_table(spark, sf_dir))


@query("report_latest", lambda: _rep_sql("WHERE wend = (SELECT max(wend) FROM wrep)"))
def q_report_latest(spark, sf_dir):
    """The newest published report."""
    t = _report_table(spark, sf_dir)
    newest = t.agg(F.max_by(F.struct(*t.columns), "wend").alias("r"))
    return rounded(newest.filter("r IS NOT NULL").select("r.*"))


# ---- S18 prediction log --------------------------------------------------------------
_PRED = ["prediction", "lower_bound", "upper_bound"]


@query("prediction_log", lambda: Q.cte(**QB._bt_ctes()) + "SELECT w.ticker, w.date, " + ", ".join(
    f"{sql_round(f'p.prediction * {k}', 6)} AS {c}" for c, k in zip(_PRED, ("1.0", "0.9", "1.1"), strict=True)) +
    f", '{QB.VERSION}' AS model_version FROM win w CROSS JOIN p50 p")
def q_prediction_log(spark, sf_dir):
    """Predictions written to the log half-year by half-year, the second
    half twice, and the whole log read back."""
    _, fm = QB._inputs(spark, sf_dir)
    pred = materialize(QB.naive_predictions(fm, QB.START), "predictions")
    root = scratch_path(spark, "prediction-log")
    half = F.when(F.month("date") <= 6, "h1").otherwise("h2")
    for h in ("h1", "h2", "h2"):
        SN.publish(pred.filter(half == h), root, f"{QB.VERSION}-{h}")
    log = SN.read_all(spark, root)
    return log.select("ticker", "date", *[round_col(F.col(c), 6).alias(c) for c in _PRED], "model_version")


# ---- ST9 late rows ---------------------------------------------------------------------
# Landings: by date, and one residue class of ids one landing late.
_LATE_MOD, _LATE_RES = 50, 11
_SECOND, _THIRD = "2024-01-11", C.BASELINE_END

_LATE_SQL = f"""
WITH arrived AS (
  SELECT event_id, event_type, ts,
    CASE WHEN ts < TIMESTAMP '{_SECOND}' THEN 0 WHEN ts < TIMESTAMP '{_THIRD}' THEN 1 ELSE 2 END
    + CASE WHEN event_id % {_LATE_MOD} = {_LATE_RES} THEN 1 ELSE 0 END AS batch
  FROM events),
highs AS (
  SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
  FROM arrived GROUP BY batch)
SELECT CAST(a.batch AS BIGINT) AS batch, event_id, event_type, ts
FROM arrived a JOIN highs h ON a.batch = h.batch
WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= date_trunc('millisecond', high) - INTERVAL 1 DAY"""


@query("stream_late_rows", _LATE_SQL)
def q_stream_late_rows(spark, sf_dir):
    """ST9: rows behind a one-day watermark of one-minute buckets.  Events land
    in four steps, after each of which the stream runs over what has arrived."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    day = F.lit(_SECOND).cast("timestamp_ntz"), F.lit(_THIRD).cast("timestamp_ntz")
    landing = (F.when(F.col("ts") < day[0], 0).when(F.col("ts") < day[1], 1).otherwise(2)
               + F.when(F.col("event_id") % _LATE_MOD == _LATE_RES, 1).otherwise(0))
    path, root = scratch_path(spark, "landed"), scratch_path(spark, "late")
    for k in range(4):
        ev.filter(landing == k).write.mode("append").parquet(path)
        late, _ = late_rows(spark.readStream.schema(ev.schema).parquet(path), "ts", 86_400, 60, root=root)
    return late.select(F.col(BATCH).alias("batch"), "event_id", "event_type", "ts")
