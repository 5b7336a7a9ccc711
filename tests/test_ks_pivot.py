"""The pivot's listed days cover every window, or the query fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsmith.plans import q_ops


def test_window_outside_the_list_is_an_error(spark, monkeypatch):
    rows = [("a", dt.datetime(2024, 1, 25), 0.5), ("a", dt.datetime(2024, 3, 1), 0.25)]
    feats = spark.createDataFrame(rows, "feature string, wend timestamp, ks_statistic double")
    monkeypatch.setattr(q_ops, "windowed_drift", lambda *a: (feats.filter(F.col("wend") < "2024-02-01"), None))
    assert q_ops.q_ks_pivot(spark, None).first()["2024-01-25"] == 0.5
    monkeypatch.setattr(q_ops, "windowed_drift", lambda *a: (feats, None))
    with pytest.raises(Exception, match="outside the listed period"):
        q_ops.q_ks_pivot(spark, None).collect()
