"""Queries: bar sources / sinks and the feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from barsmith.operators.features import feature_matrix
from barsmith.operators.profile import baseline_stats
from barsmith.plans import sql as Q
from barsmith.params import DEFAULT_FEATURES
from barsmith.plans.registry import R, query, rounded
from barsmith.sources import bars as SB
from barsmith.sources import snapshots as SN
from barsmith.sources import store as ST
from barsmith.sources.bars import bar_table, daily_bars

_OHLCV = ("open", "high", "low", "close", "volume")
_SEL = "SELECT ticker, date, " + ", ".join(R(c, c) for c in _OHLCV) + " FROM bars"


def raw_vendor_frame(spark, sf_dir):
    """A vendor frame with the raw column names (``report_date`` as text,
    capitalised price columns)."""
    b = daily_bars(spark, sf_dir)
    return b.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("report_date"),
                    F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
                    F.col("close").alias("Close"), F.col("volume").alias("Volume"))


@query("bars_normalize", lambda: Q.cte(bars=Q.BARS_D) + _SEL)
def q_bars_normalize(spark, sf_dir):
    return rounded(SB.normalize_bars(raw_vendor_frame(spark, sf_dir)))


@query("bars_range", lambda: Q.cte(bars=Q.BARS_D) + _SEL +
       " WHERE date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'")
def q_bars_range(spark, sf_dir):
    return rounded(SB.bars_in_range(daily_bars(spark, sf_dir), "1995-01-01", "1995-12-31"))


@query("bars_multi", lambda: Q.cte(bars=Q.BARS_D) + _SEL +
       " WHERE ticker IN ('Brand#11', 'Brand#23', 'Brand#35')")
def q_bars_multi(spark, sf_dir):
    return rounded(SB.bars_for_tickers(daily_bars(spark, sf_dir), ["Brand#11", "Brand#23", "Brand#35"]))


@query("bars_lookback", lambda: Q.cte(bars=Q.BARS_D) + _SEL +
       " WHERE date >= DATE '1998-12-01' - INTERVAL 730 DAY")
def q_bars_lookback(spark, sf_dir):
    return rounded(SB.bars_lookback(daily_bars(spark, sf_dir), "1998-12-01", 730))


# ---- S4 / S5 ------------------------------------------------------------------
_REJ = ("CASE WHEN (year(date) * 12 + month(date)) % 7 = 3 THEN 'rate_limited' "
        "WHEN (year(date) * 12 + month(date)) % 11 = 5 THEN 'error' END")


@query("json_series_flatten", lambda: Q.cte(bars=Q.BARS_D) + _SEL + f" WHERE {_REJ} IS NULL")
def q_json_series_flatten(spark, sf_dir):
    docs = ST.vendor_documents(daily_bars(spark, sf_dir))
    return rounded(ST.flatten_series(docs).select("ticker", "date", *_OHLCV))


@query("json_series_rejects", lambda: Q.cte(bars=Q.BARS_D) +
       f"SELECT DISTINCT ticker, strftime(date, '%Y-%m') AS month, {_REJ} AS reason FROM bars WHERE {_REJ} IS NOT NULL")
def q_json_series_rejects(spark, sf_dir):
    docs = ST.vendor_documents(daily_bars(spark, sf_dir))
    return ST.series_rejects(docs, keep=("ticker", "month"))


# ---- S6 / S8 / S9 / S10 / S11 ----------------------------------------------------
_STORE_COLS = ["ticker", "date", *DEFAULT_FEATURES.feature_names(), "target"]


def _write_fm(spark, sf_dir, name):
    path = ST.scratch_path(spark, name)
    fm = feature_matrix(bar_table(spark, sf_dir), write_once=True).select(*_STORE_COLS)
    ST.write_features(fm, path)
    return path


def _fm_sql(select, tail=""):
    return Q.cte(**Q.feature_ctes()) + f"SELECT {select} FROM fm {tail}"


@query("feature_write_read", lambda: _fm_sql("ticker, date, " + ", ".join(R(c, c) for c in _STORE_COLS[2:])))
def q_feature_write_read(spark, sf_dir):
    """Write partitioned by ticker, read back."""
    path = _write_fm(spark, sf_dir, "features")
    return rounded(ST.read_panel(spark, path).select(*_STORE_COLS))


@query("panel_scan", lambda: _fm_sql("ticker, count(*) AS n_rows", "GROUP BY ticker"))
def q_panel_scan(spark, sf_dir):
    """S8 + U1: the whole panel (every ticker partition) in one scan."""
    path = _write_fm(spark, sf_dir, "panel")
    return ST.read_panel(spark, path).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"))


@query("panel_one_ticker", lambda: _fm_sql("ticker, date, " + R("target", "target"), "WHERE ticker = 'Brand#13'"))
def q_panel_one_ticker(spark, sf_dir):
    """One ticker via partition pruning."""
    path = _write_fm(spark, sf_dir, "panel1")
    return rounded(ST.read_ticker(spark, path, "Brand#13").select("ticker", "date", "target"))


def _write_versions(spark, sf_dir):
    path = ST.scratch_path(spark, "store")
    fm = feature_matrix(bar_table(spark, sf_dir), write_once=True).select(*_STORE_COLS)
    old = fm.filter(F.col("date") < F.lit("1997-01-01").cast("date")).withColumn("date_tag", F.lit("19970101"))
    ST.write_features(old, path, by=("ticker", "date_tag"))
    new = fm.withColumn("date_tag", F.lit("20020101"))
    ST.write_features(new, path, by=("ticker", "date_tag"))     # dynamic: keeps 19970101
    return path


@query("store_versions", lambda: _fm_sql("""ticker, date_tag, count(*) AS n_rows FROM (
  SELECT ticker, '19970101' AS date_tag FROM fm WHERE date < DATE '1997-01-01'
  UNION ALL SELECT ticker, '20020101' FROM fm) GROUP BY ticker, date_tag --"""))
def q_store_versions(spark, sf_dir):
    """Two versions under one root (dynamic partition overwrite)."""
    path = _write_versions(spark, sf_dir)
    df = spark.read.parquet(path).withColumn("date_tag", F.col("date_tag").cast("string"))
    return df.groupBy("ticker", "date_tag").agg(F.count(F.lit(1)).alias("n_rows"))


@query("store_latest", lambda: _fm_sql("ticker, date, " + R("target", "target")))
def q_store_latest(spark, sf_dir):
    """The newest version per ticker."""
    path = _write_versions(spark, sf_dir)
    df = spark.read.parquet(path).withColumn("date_tag", F.col("date_tag").cast("string"))
    return rounded(ST.latest_version(df).select("ticker", "date", "target"))


def _baseline_sql():
    from barsmith.plans.q_drift import _bs_sql
    return _bs_sql()


@query("baseline_roundtrip", _baseline_sql)
def q_baseline_roundtrip(spark, sf_dir):
    """The baseline published as a snapshot, exported as JSON documents
    from there, and read back from the documents."""
    from barsmith.plans.q_drift import _event_base, FEATS, _round_arrays
    path = ST.scratch_path(spark, "baseline")
    SN.publish(baseline_stats(_event_base(spark, sf_dir), FEATS), path + "/table", "baseline")
    table = SN.read_commit(spark, path + "/table")
    SN.write_documents(table, path + "/json")
    return _round_arrays(rounded(SN.read_documents(spark, path + "/json", table.schema)), ["bin_edges"], 6)
