"""Exact quantiles and raw KS: independent of exchange reuse, with heavy ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.operators.drift import drift_features, ks_two_sample
from barsmith.operators.profile import baseline_stats, to_long
from barsmith.operators.quality import normalize_ticker, ticker_is_valid
from barsmith.operators.quantiles import exact_quantiles, rank_select
from barsmith.sources.store import read_panel
from barsmith.streaming.streams import run_to_table


@pytest.fixture(params=["true", "false"])
def reuse(spark, request):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield request.param
    spark.conf.set("spark.sql.exchange.reuse", "true")


def test_quantiles_many_files(spark, reuse, tmp_path):
    path = str(tmp_path / "values")
    d = spark.range(400_000, numPartitions=12).select((F.col("id") % 3).alias("k"), F.rand(7).alias("v"))
    # one value holds 90 % of key 2
    d.withColumn("v", F.when((F.col("k") == 2) & (F.col("v") < 0.9), 0.5).otherwise(F.col("v"))).write.parquet(path)
    df = spark.read.parquet(path)
    by = {k: np.sort([r.v for r in df.filter(F.col("k") == k).collect()]) for k in range(3)}
    probs = [0.0, 0.05, 0.5, 0.9, 0.99, 1.0]
    for r in exact_quantiles(df, ["k"], "v", probs).collect():
        assert r.q == pytest.approx(np.quantile(by[r.k], r.p), abs=1e-12)
    for r in rank_select(df, ["k"], "v", [0.5, 0.95]).collect():
        assert r.q == by[r.k][int(len(by[r.k]) * r.p)]
    every = np.sort(np.concatenate(list(by.values())))
    assert [r.q for r in exact_quantiles(df, [], "v", [0.5]).collect()] == [pytest.approx(np.quantile(every, 0.5))]
    assert not exact_quantiles(df.limit(0), ["k"], "v", probs).count()


def test_raw_ks(spark, reuse):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=3000).round(2), rng.normal(0.1, 1, 2000).round(2)
    df = spark.createDataFrame([("f", "a", float(x)) for x in a] + [("f", "b", float(x)) for x in b], "feature string, sample string, value double")
    at = np.unique(np.concatenate([a, b]))
    d = max(abs((a <= x).mean() - (b <= x).mean()) for x in at)
    assert ks_two_sample(df, ["feature"]).first().ks_statistic == pytest.approx(d, abs=1e-12)


def test_empty_live_features_stay(spark):
    base = baseline_stats(spark.range(500).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c")), ["a", "b", "c"])
    live = spark.range(200).select((F.rand(4) + 3).alias("a"), F.lit(None).cast("double").alias("b"))
    got = {r.feature: r for r in drift_features(base, to_long(live, ["a", "b"])).collect()}
    assert set(got) == {"a", "b"}  # c is no live column
    assert got["a"].ks_drifted and (got["b"].ks_statistic, got["b"].ks_p_value, got["b"].ks_drifted, got["b"].psi) == (0.0, 1.0, False, 0.0)
    none = drift_features(base, to_long(live.limit(0), ["a", "b"]), live_columns=["a", "b"]).collect()
    assert sorted((r.feature, r.ks_p_value, r.ks_drifted) for r in none) == [("a", 1.0, False), ("b", 1.0, False)]


def test_ticker_white_space(spark):
    rows = ["\tAAPL\n", " aapl", "AAPL\n\n", "A B", "AA\nPL", "", None, " MSFT "]
    df = spark.createDataFrame([(x,) for x in rows], "t string").select(normalize_ticker(F.col("t")).alias("n"), ticker_is_valid(F.col("t")).alias("ok"))
    assert [(r.n, r.ok) for r in df.collect()] == [("AAPL", True), ("AAPL", True), ("AAPL", True), ("A B", False), ("AA\nPL", False), ("", False), (None, False), ("MSFT", True)]


def test_panel_leaves_out_files_without_target(spark, tmp_path):
    path = str(tmp_path / "panel")
    spark.createDataFrame([(1.0, 2.0)], "x double, target double").write.parquet(f"{path}/ticker=A")
    spark.createDataFrame([(1.0,)], "x double").write.parquet(f"{path}/ticker=B")
    assert [r.ticker for r in read_panel(spark, path).collect()] == ["A"]
    assert read_panel(spark, path, require=None).count() == 2


def test_replayed_batch_adds_nothing(spark, tmp_path, monkeypatch):
    """Several files, one a batch; every batch is delivered twice."""
    from pyspark.sql.streaming import DataStreamWriter

    path = str(tmp_path / "in")
    for k in range(4):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(path)
    once = DataStreamWriter.foreachBatch
    monkeypatch.setattr(DataStreamWriter, "foreachBatch", lambda self, f: once(self, lambda b, i: (f(b, i), f(b, i))[0]))
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    assert sorted(r.id for r in run_to_table(stream, "replay").collect()) == list(range(40))
    none = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).filter("id < 0")
    assert not run_to_table(none, "none").count()
