"""Split-conformal prediction bands.

A model's residuals on rows that it was not fitted on are ranked, and the band
is the prediction plus the residuals of two ranks.  With n calibration rows the
upper rank is ceil((n + 1) high) and the lower one floor((n + 1) low), counted
from 1: for exchangeable rows the next residual lies above the upper one with a
chance of at most 1 - high, and below the lower one with at most low, whatever
the model.  Where n is too small for such a rank that side has no bound (NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.operators.quantiles import ranked

# The reference's p10 and p90, in thousandths.
LOW, HIGH = 100, 900


def conformal_offsets(calibration: DataFrame, by=(), *, y: str = "target", p: str = "prediction",
                      low: int = LOW, high: int = HIGH) -> DataFrame:
    """(by..., n_cal, lower_offset, upper_offset) from rows that were held out
    of the fit.  ``low`` and ``high`` are thousandths.  Rows without a target or
    a prediction do not count; keys without any have no row, and without keys
    an empty table gives one row of 0, NULL, NULL.

    Ranks are exact and come from the distributed counts of
    :func:`barsmith.operators.quantiles.ranked`; no key's rows are gathered."""
    if not 0 < low < high < 1000:
        raise ValueError("low and high must be thousandths with 0 < low < high < 1000")
    by = list(by)
    res = calibration.select(*by, (F.col(y) - F.col(p)).alias("_res"))
    keys = by or ["_all"]
    if not by:
        res = res.withColumn("_all", F.lit(0))
    first, last, n1 = F.col("_first") + 1, F.col("_last") + 1, F.col("_n") + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col("_res")))

    lower_rank = F.floor(n1 * low / F.lit(1000))
    upper_rank = F.ceil(n1 * high / F.lit(1000))
    aggs = [F.max("_n"), at(lower_rank), at(upper_rank)]
    names = ["n_cal", "lower_offset", "upper_offset"]
    r = ranked(res, keys, "_res")
    out = r.groupBy(*by).agg(*[a.alias(n) for a, n in zip(aggs, names, strict=True)])
    return out.withColumn("n_cal", F.coalesce("n_cal", F.lit(0).cast("long")))


def coverage(df: DataFrame, by=(), *, y: str = "target", lower: str = "lower_bound", upper: str = "upper_bound") -> DataFrame:
    """(by..., n_rows, coverage): the share of targets inside their band; a
    missing bound is no bound, rows without a target do not count."""
    v = F.col(y)
    inside = F.coalesce(v >= F.col(lower), F.lit(True)) & F.coalesce(v <= F.col(upper), F.lit(True))
    return df.filter(v.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(inside.cast("double")).alias("coverage"))
