"""OHLCV bar sources.

A bar table is one DataFrame for all tickers:
``ticker string, date date|timestamp, open, high, low, close, volume double``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.sources.tables import read_table

BAR_COLUMNS = ("ticker", "date", "open", "high", "low", "close", "volume")


# --------------------------------------------------------------------------
# Tick -> bar roll-up
# --------------------------------------------------------------------------
def build_bars(ticks: DataFrame, *, ticker: Column, bucket: Column, price: Column,
               size: Column, order: Column) -> DataFrame:
    """First / max / min / last price and summed size per (ticker, bucket).

    ``order`` must be a total order inside a bucket (a struct of columns);
    open/close are ``min_by`` / ``max_by`` over it.  Every aggregate is
    mergeable, so a hot (ticker, bucket) is combined map-side before the
    shuffle instead of landing whole in one task.
    """
    t = ticks.select(
        ticker.alias("ticker"), bucket.alias("date"), price.alias("_p"),
        size.alias("_v"), order.alias("_o"),
    )
    return t.groupBy("ticker", "date").agg(
        F.min_by("_p", "_o").alias("open"),
        F.max("_p").alias("high"),
        F.min("_p").alias("low"),
        F.max_by("_p", "_o").alias("close"),
        F.sum("_v").alias("volume"),
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars_d``: daily bars per part brand from ``lineitem`` x ``part``.

    price = extended price / quantity; open / close = first / last price
    under the total order (orderkey, linenumber, partkey, suppkey,
    extendedprice, quantity); volume = summed quantity.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_quantity", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # part is a dimension: the optimizer broadcasts it only when its
    # measured size is under the broadcast threshold, else sort-merge
    # (AQE splits a hot partkey).
    j = li.join(part, li.l_partkey == part.p_partkey)
    return build_bars(
        j,
        ticker=F.col("p_brand"),
        bucket=F.to_date("l_shipdate"),
        price=F.try_divide("l_extendedprice", "l_quantity"),
        size=F.col("l_quantity"),
        order=F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       "l_extendedprice", "l_quantity"),
    )


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars_h``: hourly bars per event type from ``events`` (count volume)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return build_bars(
        ev,
        ticker=F.col("event_type"),
        bucket=F.date_trunc("hour", "ts"),
        price=F.col("value"),
        size=F.lit(1.0),
        order=F.struct("ts", "event_id"),
    )


# --------------------------------------------------------------------------
# Normalise a raw vendor frame
# --------------------------------------------------------------------------
# The vendor's raw column names and the canonical names.
RAW_TO_CANONICAL = {
    "report_date": "date",
    "open": "open",
    "high": "high",
    "low": "low",
    "close": "close",
    "volume": "volume",
}


def missing_columns(df: DataFrame, required) -> list[str]:
    """U4: required - present (schema only, no job)."""
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def normalize_bars(raw: DataFrame, ticker_col: str = "ticker") -> DataFrame:
    """Rename the vendor columns, parse the date, project the bar schema.

    Raises if a source column is missing (schema check, no Spark job).
    """
    miss = missing_columns(raw, list(RAW_TO_CANONICAL))
    if miss:
        raise ValueError(f"missing source columns: {miss}")
    cols = {c.lower(): c for c in raw.columns}
    out = [F.col(ticker_col).alias("ticker")] if ticker_col in raw.columns else []
    for src, dst in RAW_TO_CANONICAL.items():
        c = F.col(cols[src])
        if dst == "date":
            c = F.to_date(c)
        else:
            c = c.cast("double")
        out.append(c.alias(dst))
    return raw.select(*out)


# --------------------------------------------------------------------------
# Range / ticker / look-back filters (pushed to the scan)
# --------------------------------------------------------------------------
def bars_in_range(bars: DataFrame, start, end) -> DataFrame:
    """Inclusive ``start <= date <= end``."""
    return bars.filter(F.col("date").between(F.lit(start).cast("date"),
                                             F.lit(end).cast("date")))


def bars_for_tickers(bars: DataFrame, tickers) -> DataFrame:
    return bars.filter(F.col("ticker").isin(list(tickers)))


def bars_lookback(bars: DataFrame, as_of, days: int = 730) -> DataFrame:
    """Rows with ``date >= as_of - days`` (``as_of`` is a parameter)."""
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    lo = F.date_sub(F.lit(as_of).cast("date"), days)
    return bars.filter(F.col("date") >= lo)


def bar_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars_d`` written once to the shared checkpoint folder and read back.

    Downstream plans use the bars in several branches (ordinal counts, the
    windowed rows, per-block totals); column pruning makes those branches'
    roll-ups differ, so without a table every branch would re-read the raw
    ticks.  Bars are small next to ticks: write once, scan many times.
    """
    from barsmith.session import materialize
    return materialize(daily_bars(spark, sf_dir), "bars_d")
