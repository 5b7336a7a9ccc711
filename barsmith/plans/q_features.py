"""Queries: bars roll-up, indicators (W2-W13), feature projection."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from barsmith.operators.features import complete_cases, feature_matrix, feature_projection
from barsmith.operators.indicators import compute_indicators, indicator_columns
from barsmith.params import DEFAULT_FEATURES as P
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, rounded
from barsmith.sources.bars import bar_table, daily_bars, hourly_bars


def _ind_query(name: str, include: tuple[str, ...], params=P):
    cols = indicator_columns(params, include)

    def build(spark, sf_dir):
        ind = compute_indicators(bar_table(spark, sf_dir), params, include)
        return rounded(ind.select("ticker", "date", *cols))

    def sql():
        ctes = Q.feature_ctes()
        sel = ", ".join(R(c, c) for c in cols)
        return Q.cte(**{k: ctes[k] for k in ("bars", "bn", "ewm", "ind", "feat")}) + \
            f"SELECT ticker, date, {sel} FROM feat"

    query(name, sql)(build)


# A15 tick -> bar roll-ups ---------------------------------------------------
@query("bars_build", lambda: Q.cte(bars=Q.BARS_D) +
       "SELECT ticker, date, " + ", ".join(R(c, c) for c in ("open", "high", "low", "close", "volume")) +
       " FROM bars")
def bars_build(spark, sf_dir):
    return rounded(daily_bars(spark, sf_dir))


@query("bars_build_hourly", lambda: Q.cte(bars=Q.BARS_H) +
       "SELECT ticker, date, " + ", ".join(R(c, c) for c in ("open", "high", "low", "close", "volume")) +
       " FROM bars")
def bars_build_hourly(spark, sf_dir):
    return rounded(hourly_bars(spark, sf_dir))


# W2-W12 one query per indicator family -------------------------------------
_ind_query("ind_sma", ("sma",))
_ind_query("ind_ema", ("ema",))
_ind_query("ind_rsi", ("rsi",))
_ind_query("ind_macd", ("macd",))
_ind_query("ind_bollinger", ("bollinger",))
_ind_query("ind_volume", ("volume",))
_ind_query("ind_obv", ("obv",))
_ind_query("ind_vwap_dev", ("vwap",))
_ind_query("ind_price", ("price",))
_ind_query("ind_lag_returns", ("lags",))
_ind_query("target_regression", ("target",))


@query("target_classification", lambda: Q.cte(bars=Q.BARS_D, bn=Q.numbered("bars")) + """
SELECT ticker, date,
  CASE WHEN (lead(close, 1) OVER (PARTITION BY ticker ORDER BY date) - close) / NULLIF(close, 0) > 0
       THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS target
FROM bn""")
def target_classification(spark, sf_dir):
    p = replace(P, target_mode="classification")
    ind = compute_indicators(bar_table(spark, sf_dir), p, ("target",))
    return rounded(ind.select("ticker", "date", "target"))


# W3-W5 with NULL closes: about every sixth day, and the first ones ---------
_HOLES = "date < DATE '1992-03-01' OR CAST(dayofyear(date) AS INT) % 6 IN (0, 1)"
_EWM_COLS = ("rsi_14", "ema_12", "ema_26", "macd_line", "macd_signal", "macd_hist")


@query("ind_ema_nulls", lambda: Q.cte(
    bars=Q.BARS_D, holed=f"  SELECT ticker, date, CASE WHEN {_HOLES} THEN NULL ELSE close END AS close FROM bars",
    bn=Q.numbered("holed"), ewm=Q.ewm_recursive_nulls("bn")) + "SELECT b.ticker, b.date, " + ", ".join(R(e, c) for e, c in zip(
        ("100 - 100 / (1 + e.ag / NULLIF(e.al, 0))", "e.e12", "e.e26", "e.e12 - e.e26", "e.sig", "(e.e12 - e.e26) - e.sig"), _EWM_COLS, strict=True)) +
       " FROM bn b JOIN ewm e ON b.ticker = e.ticker AND b.rn = e.rn")
def q_ind_ema_nulls(spark, sf_dir):
    """EMA, MACD and RSI where closes are missing inside and at the beginning."""
    bars = bar_table(spark, sf_dir).withColumn("close", F.when(~F.expr(_HOLES), F.col("close")))
    return rounded(compute_indicators(bars, P, ("rsi", "ema", "macd")).select("ticker", "date", *_EWM_COLS))


# W13 flagship -----------------------------------------------------------------
def _fm_sql(select: str, tail: str = "") -> str:
    return Q.cte(**Q.feature_ctes()) + f"SELECT {select} FROM fm {tail}"


_FM_COLS = [*P.feature_names(), "target"]


@query("feature_matrix", lambda: _fm_sql("ticker, date, " + ", ".join(R(c, c) for c in _FM_COLS)))
def q_feature_matrix(spark, sf_dir):
    return rounded(feature_matrix(bar_table(spark, sf_dir), write_once=True))


@query("feature_projection", lambda: _fm_sql("ticker, date, " + ", ".join(R(c, c) for c in P.feature_names())))
def q_feature_projection(spark, sf_dir):
    return rounded(feature_projection(feature_matrix(bar_table(spark, sf_dir), write_once=True)))


@query("feature_dropna", lambda: Q.cte(**{k: v for k, v in Q.feature_ctes().items() if k != "fm"}) +
       "SELECT ticker, count(*) AS n_rows FROM fm0 GROUP BY ticker")
def q_feature_dropna(spark, sf_dir):
    ind = compute_indicators(bar_table(spark, sf_dir), P)
    fm = complete_cases(ind.select("ticker", "date", *_FM_COLS))
    return fm.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"))


@query("feature_min_rows", lambda: Q.cte(**{k: v for k, v in Q.feature_ctes().items() if k != "fm"}) + f"""
SELECT ticker, count(*) AS n_rows, count(*) >= {P.min_rows} AS kept
FROM fm0 GROUP BY ticker""")
def q_feature_min_rows(spark, sf_dir):
    """F3 in report form: rows per ticker after dropna and the keep flag."""
    ind = compute_indicators(bar_table(spark, sf_dir), P)
    fm = complete_cases(ind.select("ticker", "date", *_FM_COLS))
    cnt = fm.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"))
    return cnt.withColumn("kept", F.col("n_rows") >= P.min_rows)


@query("feature_matrix_hourly", lambda: Q.cte(**Q.feature_ctes(Q.BARS_H)) +
       "SELECT ticker, date, " + ", ".join(R(c, c) for c in _FM_COLS) + " FROM fm")
def q_feature_matrix_hourly(spark, sf_dir):
    """W13 on hourly bars (``bars_h`` from events): the same operators with a
    timestamp order column."""
    from barsmith.session import materialize
    bars = materialize(hourly_bars(spark, sf_dir), "bars_h")
    return rounded(feature_matrix(bars, write_once=True))
