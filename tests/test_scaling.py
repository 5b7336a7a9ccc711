"""The scaler stage against numpy, saved and loaded, with odd columns."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from barsmith.operators.scaling import ColumnScaler


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    a = rng.normal(5, 3, 201)
    return spark.createDataFrame([(k, float(x), None if k % 4 == 0 else float(x * x), 7.0, None, "s") for k, x in enumerate(a)],
                                 "k int, a double, b double, flat double, none double, note string")


@pytest.mark.parametrize("method", ["robust", "standard"])
def test_stage_scales_as_numpy(spark, rows, method, tmp_path):
    cols = ["a", "b", "flat", "none"]
    fitted = Pipeline(stages=[ColumnScaler(inputCols=cols, method=method)]).fit(rows)
    fitted.write().save(str(tmp_path / "pipe"))
    loaded = PipelineModel.load(str(tmp_path / "pipe"))
    got = loaded.transform(rows).orderBy("k").toPandas()
    src = rows.orderBy("k").toPandas()
    assert list(got.columns) == rows.columns and (got.note == "s").all() and got.none.isna().all()
    for c in ("a", "b", "flat"):
        x = src[c].dropna().to_numpy(dtype=float)
        centre, scale = (np.median(x), np.subtract(*np.quantile(x, [0.75, 0.25]))) if method == "robust" else (x.mean(), x.std())
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), (src[c].to_numpy(dtype=float) - centre) / (scale or 1.0), rtol=1e-9, atol=1e-12)
    assert loaded.stages[0].parameters(spark).count() == 4
    plan = loaded.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_unknown_method_is_refused(rows):
    with pytest.raises(ValueError):
        ColumnScaler(inputCols=["a"], method="other").fit(rows)
