"""Capture-log parsing edge cases and the backtest's business-day mapping."""

import base64
import datetime as dt
import json

from pyspark.sql import functions as F

from barsmith.operators import backtest as B
from barsmith.sources import captures as C


def _line(data, enc="BASE64"):
    ei = {"data": data} if enc is None else {"encoding": enc, "data": data}
    return json.dumps({"captureData": {"endpointInput": ei}})


def test_parse_captures_edge_cases(spark):
    body = json.dumps({"ticker": "AAPL", "features": [1.5, 2.0, 3.25]})
    b64 = base64.b64encode(body.encode()).decode()
    lines = [
        (1, _line(b64)),                                    # base64 body
        (2, _line(body, "JSON")),                           # plain body
        (3, _line(b64, None)),                              # encoding missing -> BASE64
        (4, _line("%%%not-base64%%%")),                     # corrupt body
        (5, ""),                                            # blank line
        (6, "   "),                                         # whitespace only
        (7, "{not json"),                                   # malformed record
        (8, _line(json.dumps({"ticker": "X", "features": []}), "JSON")),   # empty list
        (9, _line(json.dumps({"ticker": "X"}), "JSON")),                   # no features
    ]
    df = spark.createDataFrame(lines, "id long, value string")
    got = {r.id: r.features for r in C.parse_captures(df).collect()}
    assert set(got) == {1, 2, 3}
    assert all(v == [1.5, 2.0, 3.25] for v in got.values())


def test_path_date_pruning(spark):
    paths = [("captures/2024/01/20/10/a.jsonl",), ("captures/2024/01/29/10/b.jsonl",),
             ("captures/undated/c.jsonl",), ("captures/2024/13/40/00/d.jsonl",)]
    df = spark.createDataFrame(paths, "path string")
    kept = sorted(r.path for r in C.recent_files(df, "2024-01-30", 7).collect())
    # dated within 7 days kept, old dated dropped, undated / invalid kept
    assert kept == sorted([paths[1][0], paths[2][0], paths[3][0]])


def test_vector_validation(spark):
    rows = [(1, [0.0] * 30), (2, [1.0] * 23), (3, [float("nan")] + [0.0] * 29),
            (4, [0.0] * 29 + [float("inf")]), (5, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = {r.id: (r.ok, r.p) for r in df.select(
        "id", C.vector_is_valid(F.col("v"), 30).alias("ok"), C.vector_problems(F.col("v"), 30).alias("p")).collect()}
    assert out[1] == (True, [])
    assert out[2][0] is False and out[2][1] == ["Expected 30 features, got 23"]
    assert out[3][1] == ["Feature[0] is not finite"] and out[4][1] == ["Feature[29] is not finite"]
    assert out[5][0] is False


def test_backtest_business_days(spark):
    d = dt.date
    feats = spark.createDataFrame([
        ("T", d(2024, 1, 4), 100.0, 0.01),    # Thu -> Fri
        ("T", d(2024, 1, 5), 101.0, 0.02),    # Fri -> Mon
        ("T", d(2024, 1, 6), 0.0, 0.00),      # Sat -> Mon, zero prev close -> no price
        ("T", d(2024, 1, 9), 102.0, 0.00),    # Tue -> Wed (no bar on Wed)
    ], "ticker string, date date, close double, target double")
    bars = spark.createDataFrame([("T", d(2024, 1, 5), 101.0), ("T", d(2024, 1, 8), 103.0)],
                                 "ticker string, date date, close double")
    preds = feats.select("ticker", "date", F.lit(0.1).alias("prediction"), F.lit(0.05).alias("lower_bound"),
                         F.lit(0.2).alias("upper_bound"), F.lit("v1").alias("model_version"))
    bt = B.backtest_prices(feats, bars, preds, "2024-01-05", "2024-01-10").orderBy("feature_date").collect()
    assert [(r.feature_date, r.date) for r in bt] == [
        (d(2024, 1, 4), d(2024, 1, 5)), (d(2024, 1, 5), d(2024, 1, 8)),
        (d(2024, 1, 6), d(2024, 1, 8)), (d(2024, 1, 9), d(2024, 1, 10))]
    assert bt[0].actual_close == 101.0 and bt[0].predicted_close == 110.0 and bt[0].lower_price == 105.0
    assert bt[2].predicted_close is None                  # prev close 0 is falsy
    assert bt[3].actual_close is None                     # no bar on the prediction date
    last = B.backtest_last(spark.createDataFrame(bt)).first()
    # the Sat row maps to the same Monday but has no price: the Fri row is the last complete one
    assert last.last_date == d(2024, 1, 8) and last.last_predicted == bt[1].predicted_close
