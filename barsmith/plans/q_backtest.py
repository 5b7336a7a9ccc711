"""Queries: business-day backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from barsmith.functions.dates import bday_add
from barsmith.operators import backtest as B
from barsmith.operators.features import feature_matrix
from barsmith.operators.quantiles import exact_quantiles, wide_quantiles
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, rounded
from barsmith.session import materialize
from barsmith.sources.bars import bar_table, daily_bars

# Fixed backtest window (one year inside the 1995-2001 ship-date range).
START, END = "1998-01-01", "1998-12-31"
VERSION = "naive-mean"
LO = Q.bday_sql(f"DATE '{START}'", -1)
HI = Q.bday_sql(f"DATE '{END}'", -1)


def _inputs(spark, sf_dir):
    bars = bar_table(spark, sf_dir)
    fm = feature_matrix(bars, keep=("close",), write_once=True)
    return bars, fm


def naive_predictions(fm, start: str):
    """p50 = mean training target (rows before the window), fallback bounds."""
    lo = bday_add(F.lit(start).cast("date"), -1)
    p50 = fm.filter(F.col("date") < lo).agg(F.avg("target").alias("prediction"))   # one row
    lower, upper = B.interval_fallback(F.col("prediction"))
    return (B.backtest_window(fm, start, END).select("ticker", "date")
            .crossJoin(F.broadcast(p50))
            .select("ticker", "date", "prediction", lower.alias("lower_bound"),
                    upper.alias("upper_bound"), F.lit(VERSION).alias("model_version")))


def _bt(spark, sf_dir):
    bars, fm = _inputs(spark, sf_dir)
    return B.backtest_prices(fm, bars, naive_predictions(fm, START), START, END)


def _bt_ctes():
    c = Q.feature_ctes()
    c["win"] = f"  SELECT * FROM fm WHERE date BETWEEN {LO} AND {HI}"
    c["p50"] = f"  SELECT avg(target) AS prediction FROM fm WHERE date < {LO}"
    c["bt"] = f"""
  SELECT {Q.bday_sql('w.date', 1)} AS date, w.ticker, w.date AS feature_date, b.close AS actual_close,
    CASE WHEN w.close <> 0 THEN round(w.close * (1 + p.prediction) * 100) / 100 END AS predicted_close,
    CASE WHEN w.close <> 0 THEN round(w.close * (1 + p.prediction * 0.9) * 100) / 100 END AS lower_price,
    CASE WHEN w.close <> 0 THEN round(w.close * (1 + p.prediction * 1.1) * 100) / 100 END AS upper_price,
    round(p.prediction * 1000000) / 1000000 AS predicted_return, w.target AS actual_return,
    w.close AS prev_close, '{VERSION}' AS model_version
  FROM win w CROSS JOIN p50 p
  LEFT JOIN bars b ON b.ticker = w.ticker AND b.date = {Q.bday_sql('w.date', 1)}"""
    return c


_BT_COLS = ["date", "ticker", "feature_date", "actual_close", "predicted_close", "lower_price", "upper_price",
            "predicted_return", "actual_return", "prev_close", "model_version"]


@query("backtest_prices", lambda: Q.cte(**_bt_ctes()) + "SELECT " + ", ".join(
    c if c in ("date", "ticker", "feature_date", "model_version") else R(c, c) for c in _BT_COLS) + " FROM bt")
def q_backtest_prices(spark, sf_dir):
    return rounded(_bt(spark, sf_dir))


@query("backtest_window", lambda: Q.cte(**_bt_ctes()) + "SELECT ticker, date FROM win")
def q_backtest_window(spark, sf_dir):
    _, fm = _inputs(spark, sf_dir)
    return B.backtest_window(fm, START, END).select("ticker", "date")


@query("backtest_join", lambda: Q.cte(**_bt_ctes()) +
       "SELECT ticker, date, " + R("prev_close", "prev_close") + ", " + R("actual_close", "actual_close") + " FROM bt")
def q_backtest_join(spark, sf_dir):
    """J2 + J3: feature row at T-1 with the close of T (left) and of T-1."""
    return rounded(_bt(spark, sf_dir).select("ticker", "date", "prev_close", "actual_close"))


@query("backtest_metrics", lambda: Q.cte(**_bt_ctes()) + """
SELECT ticker, """ + R("avg(CAST(sign(actual_close - prev_close) = sign(predicted_return) AS DOUBLE)) * 100.0",
                       "directional_accuracy_pct") + ", " + R("avg(abs(actual_close - predicted_close))", "mae_price") + """,
       count(*) AS n_rows
FROM bt WHERE predicted_close IS NOT NULL AND actual_close IS NOT NULL AND prev_close IS NOT NULL
GROUP BY ticker""")
def q_backtest_metrics(spark, sf_dir):
    return rounded(B.backtest_metrics(_bt(spark, sf_dir)))


@query("backtest_last", lambda: Q.cte(**_bt_ctes()) + """
SELECT ticker, max(date) AS last_date, """ + R("arg_max(actual_close, (date, feature_date))", "last_actual") + ", " +
       R("arg_max(predicted_close, (date, feature_date))", "last_predicted") + """
FROM bt WHERE predicted_close IS NOT NULL AND actual_close IS NOT NULL AND prev_close IS NOT NULL
GROUP BY ticker""")
def q_backtest_last(spark, sf_dir):
    return rounded(B.backtest_last(_bt(spark, sf_dir)))


@query("bday_shift", lambda: Q.cte(bars=Q.BARS_D) + f"""
SELECT date, {Q.bday_sql('date', 1)} AS next_bday, {Q.bday_sql('date', -1)} AS prev_bday
FROM (SELECT DISTINCT date FROM bars)""")
def q_bday_shift(spark, sf_dir):
    d = daily_bars(spark, sf_dir).select("date").distinct()
    return d.select("date", bday_add(F.col("date"), 1).alias("next_bday"),
                    bday_add(F.col("date"), -1).alias("prev_bday"))


@query("close_reconstruct", lambda: Q.cte(**Q.feature_ctes()) + """
SELECT coalesce(b.ticker, f.ticker) AS ticker, coalesce(b.date, f.date) AS date,
  """ + R("coalesce(b.close, round((f.bb_lower + f.bb_pct_b * (f.bb_upper - f.bb_lower)) * 10000) / 10000)",
          "close") + """,
  CASE WHEN b.close IS NOT NULL THEN 'raw' ELSE 'rebuilt' END AS source,
  abs(f.bb_lower + f.bb_pct_b * (f.bb_upper - f.bb_lower) - b.close) < 1e-6 AS rebuilt_ok
FROM bars b FULL OUTER JOIN fm f ON b.ticker = f.ticker AND b.date = f.date""")
def q_close_reconstruct(spark, sf_dir):
    """S19 + N3: raw close where a bar exists, else rebuilt from the bands;
    ``rebuilt_ok`` checks the reconstruction against the raw close (the
    rebuilt value approximates prices that sit on rounding ties, so it is
    compared with a tolerance rather than hashed)."""
    bars, fm = _inputs(spark, sf_dir)
    raw_rebuilt = F.col("bb_lower") + F.col("bb_pct_b") * (F.col("bb_upper") - F.col("bb_lower"))
    rebuilt = fm.select("ticker", "date", raw_rebuilt.alias("_rb"), B.reconstruct_close(
        F.col("bb_lower"), F.col("bb_pct_b"), F.col("bb_upper")).alias("close_rebuilt"))
    j = bars.select("ticker", "date", "close").join(rebuilt, ["ticker", "date"], "full_outer")
    return rounded(j.select(
        "ticker", "date", F.coalesce("close", "close_rebuilt").alias("close"),
        F.when(F.col("close").isNotNull(), "raw").otherwise("rebuilt").alias("source"),
        (F.abs(F.col("_rb") - F.col("close")) < 1e-6).alias("rebuilt_ok")))


@query("interval_fallback", lambda: Q.cte(**_bt_ctes()) + """
SELECT w.ticker, w.date, """ + R("p.prediction", "prediction") + ", " + R("p.prediction * 0.9", "lower_bound") +
       ", " + R("p.prediction * 1.1", "upper_bound") + " FROM win w CROSS JOIN p50 p")
def q_interval_fallback(spark, sf_dir):
    _, fm = _inputs(spark, sf_dir)
    return rounded(naive_predictions(fm, START).select("ticker", "date", "prediction", "lower_bound",
                                                       "upper_bound"))


@query("predict_interval", lambda: Q.cte(**_bt_ctes()) + """
SELECT r.ticker, """ + R("p.prediction", "prediction") + ", " +
       R("p.prediction + quantile_cont(r.target - p.prediction, 0.1)", "lower_bound") + ", " +
       R("p.prediction + quantile_cont(r.target - p.prediction, 0.9)", "upper_bound") + """
FROM fm r CROSS JOIN p50 p WHERE r.date < """ + LO + " GROUP BY r.ticker, p.prediction")
def q_predict_interval(spark, sf_dir):
    """L5 re-aim: p50 plus the 10 % / 90 % quantiles of the training
    residuals, per ticker (exact distributed quantiles)."""
    _, fm = _inputs(spark, sf_dir)
    lo = bday_add(F.lit(START).cast("date"), -1)
    hist = fm.filter(F.col("date") < lo)
    p50 = hist.agg(F.avg("target").alias("prediction"))
    res = hist.crossJoin(F.broadcast(p50)).select(
        "ticker", (F.col("target") - F.col("prediction")).alias("resid"))
    q = wide_quantiles(exact_quantiles(res, ["ticker"], "resid", [0.1, 0.9]), ["ticker"],
                       {0.1: "q10", 0.9: "q90"})
    out = q.crossJoin(F.broadcast(p50)).select(
        "ticker", "prediction", (F.col("prediction") + F.col("q10")).alias("lower_bound"),
        (F.col("prediction") + F.col("q90")).alias("upper_bound"))
    return rounded(out)
