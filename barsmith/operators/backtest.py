"""Price backtest of return predictions on business days.

Feature row at T-1 (features + target = return T-1 -> T) predicts the
close of T = next business day: predicted = round(prev * (1 + r), 2).
One vectorised job instead of one request per row; the actual close is
an equi-join on (ticker, next business day), NULL when T has no bar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions.dates import bday_add
from barsmith.functions.numeric import round_half_away


def backtest_window(features: DataFrame, start: str, end: str) -> DataFrame:
    """feature rows whose next business day is in [start, end]
    (``start - 1 BDay <= date <= end - 1 BDay``)."""
    lo = bday_add(F.lit(start).cast("date"), -1)
    hi = bday_add(F.lit(end).cast("date"), -1)
    return features.filter(F.col("date").between(lo, hi))


def interval_fallback(p50: Column) -> tuple[Column, Column]:
    """No quantile model -> (p50 * 0.9, p50 * 1.1) (inverts when p50 < 0)."""
    return p50 * F.lit(0.9), p50 * F.lit(1.1)


def price_from_return(prev: Column, r: Column) -> Column:
    """round(prev * (1 + r), 2); NULL when prev is NULL or 0."""
    return F.when(prev != 0, round_half_away(prev * (F.lit(1.0) + r), 2))


def reconstruct_close(bb_lower: Column, bb_pct_b: Column, bb_upper: Column) -> Column:
    """close = lower + %b * (upper - lower), rounded to 4."""
    return round_half_away(bb_lower + bb_pct_b * (bb_upper - bb_lower), 4)


def backtest_prices(features: DataFrame, bars: DataFrame, predictions: DataFrame,
                    start: str, end: str) -> DataFrame:
    """L11.

    ``features``: ticker, date, close (close at the feature date), target.
    ``predictions``: ticker, date, prediction, lower_bound, upper_bound,
    model_version (one row per feature row).
    """
    f = backtest_window(features, start, end).select(
        "ticker", "date", F.col("close").alias("prev_close"), "target")
    p = predictions.select("ticker", "date", "prediction", "lower_bound", "upper_bound", "model_version")
    f = f.join(p, ["ticker", "date"])
    f = f.withColumn("pred_date", bday_add(F.col("date"), 1))
    actual = bars.select("ticker", F.col("date").alias("pred_date"), F.col("close").alias("actual_close"))
    j = f.join(actual, ["ticker", "pred_date"], "left")                    # J2
    prev = F.col("prev_close")
    return j.select(
        F.col("pred_date").alias("date"), "ticker", F.col("date").alias("feature_date"), "actual_close",
        price_from_return(prev, F.col("prediction")).alias("predicted_close"),
        price_from_return(prev, F.col("lower_bound")).alias("lower_price"),
        price_from_return(prev, F.col("upper_bound")).alias("upper_price"),
        round_half_away(F.col("prediction"), 6).alias("predicted_return"),
        F.col("target").alias("actual_return"),
        "prev_close", "model_version")


def backtest_metrics(bt: DataFrame, by=("ticker",)) -> DataFrame:
    """A10: directional accuracy (%) and MAE in price over complete rows."""
    v = bt.dropna(subset=["predicted_close", "actual_close", "prev_close"])
    hit = (F.signum(F.col("actual_close") - F.col("prev_close")) == F.signum("predicted_return"))
    return v.groupBy(*by).agg(
        (F.avg(hit.cast("double")) * F.lit(100.0)).alias("directional_accuracy_pct"),
        F.avg(F.abs(F.col("actual_close") - F.col("predicted_close"))).alias("mae_price"),
        F.count(F.lit(1)).alias("n_rows"))


def backtest_last(bt: DataFrame, by=("ticker",)) -> DataFrame:
    """Last complete row per ticker (``max_by``, no sort).  Fri/Sat/Sun
    feature rows share Monday's prediction date: the later feature date wins."""
    v = bt.dropna(subset=["predicted_close", "actual_close", "prev_close"])
    last = F.max_by(F.struct("date", "actual_close", "predicted_close"), F.struct("date", "feature_date"))
    return v.groupBy(*by).agg(last.alias("_l")).select(
        *by, F.col("_l.date").alias("last_date"), F.col("_l.actual_close").alias("last_actual"),
        F.col("_l.predicted_close").alias("last_predicted"))
