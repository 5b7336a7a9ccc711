"""Temporal splits over the pooled panel (M1-M3).

The reference numbers the pooled multi-ticker rows by time and cuts at
row positions.  The global position here comes from count tables, never
from a one-partition window over the rows:

  rows per day  ->  day offset inside its month (window per month)
  rows per month -> month offset (window over the month table; its size is
                    bounded by the calendar, ~12 rows a year)
  position = month offset + day offset + row_number() inside the day

A day partition holds at most one row per series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.params import SplitParams, DEFAULT_SPLITS

GORD = "_gord"   # 0-based pooled position
GN = "_gn"       # pooled row count


def global_ordinal(df: DataFrame, order: str = "date", tiebreak=("ticker",)) -> DataFrame:
    """Add ``_gord`` (pooled position by (order, tiebreak)) and ``_gn``."""
    day = F.date_trunc("day", F.col(order)) if dict(df.dtypes)[order] != "date" else F.col(order)
    d = df.withColumn("_day", day)
    days = d.groupBy("_day").agg(F.count(F.lit(1)).alias("_c")) \
        .withColumn("_mon", F.date_trunc("month", "_day"))
    in_mon = Window.partitionBy("_mon").orderBy("_day")
    days = days.withColumn(
        "_doff", F.sum("_c").over(in_mon.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c"))
    mons = days.groupBy("_mon").agg(F.sum("_c").alias("_mc"))
    # month table: one row per calendar month
    over_mon = Window.orderBy("_mon")
    mons = mons.select(
        "_mon",
        (F.sum("_mc").over(over_mon.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_mc")).alias("_moff"),
        F.sum("_mc").over(Window.partitionBy()).alias(GN),
    )
    offs = days.join(mons, "_mon").select("_day", (F.col("_moff") + F.col("_doff")).alias("_off"), GN)
    rn = F.row_number().over(Window.partitionBy("_day").orderBy(order, *tiebreak))
    return (d.join(offs, "_day")
             .withColumn(GORD, F.col("_off") + rn - 1)
             .drop("_day", "_off"))


def date_ordinal(df: DataFrame, order: str = "date") -> DataFrame:
    """``unit="dates"``: position of the row's date among distinct dates
    (all series of one date share it, so a gap never splits a date)."""
    dates = df.select(order).distinct()
    return global_ordinal(dates, order, tiebreak=()).join(df, order)


def _ordinal(df, params: SplitParams, order: str):
    return date_ordinal(df, order) if params.unit == "dates" else global_ordinal(df, order)


def temporal_split(df: DataFrame, params: SplitParams = DEFAULT_SPLITS,
                   order: str = "date") -> DataFrame:
    """M1: ``split`` = train for the first int(n*(1-test_size)) rows."""
    d = _ordinal(df, params, order)
    cut = F.floor(F.col(GN) * F.lit(1.0 - params.test_size))
    return d.withColumn("split", F.when(F.col(GORD) < cut, "train").otherwise("test")) \
        .drop(GORD, GN)


def three_way_split(df: DataFrame, params: SplitParams = DEFAULT_SPLITS,
                    order: str = "date") -> DataFrame:
    """M2: test from int(0.9 n); validation from int(test_idx * 0.875)."""
    d = _ordinal(df, params, order)
    test_idx = F.floor(F.col(GN) * F.lit(1.0 - params.test_size))
    val_idx = F.floor(test_idx * F.lit(params.val_fraction))
    split = (F.when(F.col(GORD) < val_idx, "train")
              .when(F.col(GORD) < test_idx, "val").otherwise("test"))
    return d.withColumn("split", split).drop(GORD, GN)


def walk_forward_folds(df: DataFrame, params: SplitParams = DEFAULT_SPLITS,
                       order: str = "date") -> DataFrame:
    """M3: expanding-window folds (TimeSeriesSplit(n_splits, gap)).

    k = n // (s + 1); fold i (1..s) validates [n - (s-i+1)k, +k) and trains
    on [0, val_start - gap).  Output: one row per (fold, role, input row).
    """
    s, gap = params.n_splits, params.gap
    d = _ordinal(df, params, order)
    k = F.floor(F.col(GN) / F.lit(s + 1))
    pos = F.col(GORD)
    # each row is considered for every fold (s copies, s = 3 by default)
    d = d.withColumn("fold", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(s).cast("long"))))
    vstart = F.col(GN) - (F.lit(s + 1) - F.col("fold")) * k
    role = (F.when((pos >= vstart) & (pos < vstart + k), "val")
             .when(pos < vstart - F.lit(gap), "train"))
    return d.withColumn("role", role).filter(F.col("role").isNotNull()).drop(GORD, GN)


def fold_summary(folds: DataFrame, order: str = "date") -> DataFrame:
    """One row per (fold, role): rows, first and last date."""
    return folds.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(order).alias("start_date"),
        F.max(order).alias("end_date"),
    )
