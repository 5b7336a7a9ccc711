"""Regression / direction metrics (A6), fold averages (A7), naive mean.

Every metric is one mergeable aggregate, so evaluation of any number of
(model, fold) groups is a single ``groupBy``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions.numeric import round_half_away

METRICS = ["rmse", "mae", "mape", "directional_accuracy", "sharpe_proxy", "n_samples"]


def metric_aggs(y: Column, p: Column) -> list[Column]:
    """rmse, mae, mape (%, zero truths ignored), directional accuracy,
    Sharpe proxy mean/pop-std of sign(pred)*truth * sqrt(252) (NULL when
    the std is 0), n — rounded 6/6/4/4/4 like the reference."""
    err = y - p
    sr = F.signum(p) * y
    mape = F.avg(F.when(y != 0, F.abs(err / y))) * F.lit(100.0)
    da = F.avg((F.signum(y) == F.signum(p)).cast("double"))
    sd = F.stddev_pop(sr)
    sharpe = F.when(sd > 0, F.avg(sr) / sd * F.lit(math.sqrt(252.0)))
    return [
        round_half_away(F.sqrt(F.avg(err * err)), 6).alias("rmse"),
        round_half_away(F.avg(F.abs(err)), 6).alias("mae"),
        round_half_away(mape, 4).alias("mape"),
        round_half_away(da, 4).alias("directional_accuracy"),
        round_half_away(sharpe, 4).alias("sharpe_proxy"),
        F.count(F.lit(1)).alias("n_samples"),
    ]


def compute_metrics(df: DataFrame, y: str = "target", p: str = "prediction",
                    by: list[str] | None = None) -> DataFrame:
    """A6 per group (``by``) or overall."""
    aggs = metric_aggs(F.col(y), F.col(p))
    return df.groupBy(*(by or [])).agg(*aggs)


def cv_average(fold_metrics: DataFrame, by: list[str], rnd: int | None = 6) -> DataFrame:
    """Mean of every numeric metric over folds (incl. n_samples);
    ``rnd=None`` keeps full precision (the main trainer does not round)."""
    out = []
    for m in METRICS:
        a = F.avg(F.col(m))
        out.append((round_half_away(a, rnd) if rnd is not None else a).alias(m))
    return fold_metrics.groupBy(*by).agg(*out)


def naive_mean(train: DataFrame, target: str = "target", by: list[str] | None = None) -> DataFrame:
    """The mean of the training target (per group ``by``)."""
    return train.groupBy(*(by or [])).agg(F.avg(target).alias("prediction"))
