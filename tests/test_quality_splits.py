"""Data-quality rules, business days, splits/folds and scalers on hand-made tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.functions.dates import bday_add
from barsmith.operators import quality as QL
from barsmith.operators import splits as SP
from barsmith.operators.metrics import compute_metrics
from barsmith.operators.scaling import apply_scaler, fit_robust, fit_standard
from barsmith.params import SplitParams


def test_validator_rules(spark):
    rows = [("T", dt.date(2024, 1, d), o, h, l, c, v) for d, o, h, l, c, v in [
        (1, 10.0, 11.0, 9.0, 10.0, 100.0),
        (2, 0.0, 11.0, 9.0, 10.0, 100.0),        # non-positive price
        (3, 10.0, 8.0, 9.0, 10.0, 100.0),        # high < low
        (3, 10.0, 11.0, 9.0, None, 100.0),       # duplicate date, null close
        (4, 10.0, 11.0, 9.0, 10.0, -5.0),        # negative volume
    ]]
    df = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, "
                                     "close double, volume double")
    r = QL.validate_ohlcv(df, min_rows=3).first()
    assert not r.valid
    assert "T: 1 rows with non-positive prices" in r.errors
    assert "T: 1 rows where High < Low" in r.errors
    assert "T: 1 rows with negative volume" in r.errors
    assert "T.close: null fraction 20.0% > 5%" in r.errors
    assert r.warnings == ["T: 1 duplicate timestamps in index"]
    with pytest.raises(ValueError):
        QL.assert_valid(df, min_rows=3)
    missing = QL.validate_ohlcv(df.drop("volume")).first()
    assert "missing required columns" in missing.errors[0]


def test_ticker_rule(spark):
    df = spark.createDataFrame([(" aapl ",), ("aapl123!",), ("GOOGLX",), ("",)], "raw string")
    got = df.select(QL.ticker_is_valid(F.col("raw")).alias("v")).toPandas().v.tolist()
    assert got == [True, False, False, False]


def test_business_day_shift(spark):
    # Thu Fri Sat Sun Mon
    days = [dt.date(2024, 1, d) for d in (4, 5, 6, 7, 8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select(bday_add(F.col("d"), 1).alias("n"), bday_add(F.col("d"), -1).alias("p")).collect()
    exp_next = [(pd.Timestamp(d) + pd.offsets.BDay(1)).date() for d in days]
    exp_prev = [(pd.Timestamp(d) - pd.offsets.BDay(1)).date() for d in days]
    assert [r.n for r in out] == exp_next and [r.p for r in out] == exp_prev


def _panel(spark, n_dates=40, tickers=("A", "B", "C")):
    rows = [(t, dt.date(2023, 1, 1) + dt.timedelta(days=i), float(i), float(i % 5 - 2))
            for i in range(n_dates) for t in tickers]
    return spark.createDataFrame(rows, "ticker string, date date, x double, target double")


def test_global_ordinal_and_splits(spark):
    df = _panel(spark)
    g = SP.global_ordinal(df).toPandas().sort_values(["date", "ticker"])
    assert g._gord.tolist() == list(range(len(g))) and (g._gn == len(g)).all()
    s = SP.three_way_split(df).toPandas().sort_values(["date", "ticker"])
    n = len(s)
    test_idx = int(n * 0.9)
    val_idx = int(test_idx * 0.875)
    assert s.split.tolist() == ["train"] * val_idx + ["val"] * (test_idx - val_idx) + ["test"] * (n - test_idx)


def test_walk_forward_matches_time_series_split(spark):
    df = _panel(spark, 37)
    n, s, gap = 37 * 3, 3, 5
    f = SP.walk_forward_folds(df, SplitParams(n_splits=s, gap=gap)).toPandas()
    g = SP.global_ordinal(df).toPandas().set_index(["ticker", "date"])._gord
    f["pos"] = [g.loc[(t, d)] for t, d in zip(f.ticker, f.date)]
    k = n // (s + 1)
    for i in range(1, s + 1):
        vs = n - (s - i + 1) * k
        fold = f[f.fold == i]
        assert sorted(fold[fold.role == "val"].pos) == list(range(vs, vs + k))
        assert sorted(fold[fold.role == "train"].pos) == list(range(0, vs - gap))
    # leak-safe variant: a date is never split between train and validation
    fd = SP.walk_forward_folds(df, SplitParams(unit="dates")).toPandas()
    for i in range(1, s + 1):
        fold = fd[fd.fold == i]
        assert not set(fold[fold.role == "train"].date) & set(fold[fold.role == "val"].date)


def test_scalers_match_numpy(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=101), "b": np.ones(101)})
    df = spark.createDataFrame(pdf)
    rob = fit_robust(df, ["a", "b"]).toPandas().set_index("feature")
    q25, q50, q75 = np.percentile(pdf.a, [25, 50, 75])
    assert rob.loc["a", "center"] == pytest.approx(q50) and rob.loc["a", "scale"] == pytest.approx(q75 - q25)
    assert rob.loc["b", "scale"] == 1.0                    # zero IQR -> 1
    std = fit_standard(df, ["a", "b"]).toPandas().set_index("feature")
    assert std.loc["a", "scale"] == pytest.approx(np.std(pdf.a))
    out = apply_scaler(df, fit_robust(df, ["a", "b"]), ["a", "b"]).toPandas()
    np.testing.assert_allclose(out.a, (pdf.a - q50) / (q75 - q25))


def test_metrics(spark):
    y = np.array([0.01, -0.02, 0.0, 0.03])
    p = np.array([0.02, -0.01, 0.01, -0.01])
    df = spark.createDataFrame(pd.DataFrame({"target": y, "prediction": p}))
    m = compute_metrics(df).first()
    assert m.rmse == round(float(np.sqrt(np.mean((y - p) ** 2))), 6)
    assert m.mae == round(float(np.mean(np.abs(y - p))), 6)
    nz = y != 0
    assert m.mape == round(float(np.mean(np.abs((y[nz] - p[nz]) / y[nz])) * 100), 4)
    assert m.directional_accuracy == round(float(np.mean(np.sign(y) == np.sign(p))), 4)
    sr = np.sign(p) * y
    assert m.sharpe_proxy == pytest.approx(round(float(np.mean(sr) / np.std(sr) * np.sqrt(252)), 4))
    assert m.n_samples == 4
