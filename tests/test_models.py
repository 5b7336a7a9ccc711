"""Boosted trees and the parameter search do the reference's whole budget."""

import numpy as np
import pytest

from barsmith.operators import models as M
from barsmith.params import DEFAULT_MODELS


def test_stopping_rule():
    assert M.stopped_at([5, 4, 3, 3, 3.5, 4], 3) == 6 and M.stopped_at([5, 4, 3, 3, 2, 4], 3) is None
    assert (DEFAULT_MODELS.n_estimators, DEFAULT_MODELS.early_stopping_rounds, DEFAULT_MODELS.n_trials) == (500, 30, 50)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2))
    y = 3 * x[:, 0] + np.sin(3 * x[:, 1]) + 0.1 * rng.normal(size=600)
    return spark.createDataFrame([(float(a), float(b), float(c), k % 4 == 0, k) for k, ((a, b), c) in enumerate(zip(x, y, strict=True))],
                                 "a double, b double, target double, is_val boolean, k long").coalesce(1).cache()


def test_boosting_goes_on_while_validation_improves(rows):
    fit = lambda **kw: M.fit_gbt(rows, ["a", "b"], depth=2, subsample=1.0, colsample="all", validation_col="is_val", **kw)
    m, val = fit(max_iter=40, patience=5), rows.filter("is_val")
    errors = m.stages[-1].evaluateEachIteration(m.stages[0].transform(val), "squared")
    assert len(errors) == 40 and min(errors) == errors[-1]  # each round still gains: Spark's tolerance ends far earlier
    short = M.first_rounds(m, 7)
    again = M.fit_gbt(rows.filter("not is_val"), ["a", "b"], depth=2, subsample=1.0, colsample="all", max_iter=7)
    p, q = ([r.prediction for r in x.transform(val).orderBy("k").collect()] for x in (short, again))
    assert short.stages[-1].getNumTrees == 7 and np.allclose(p, q)
    assert len(M.top_importances(short, ["a", "b"])) == 2


def test_search_scores_as_the_single_fits(spark, rows):
    from pyspark.sql import functions as F

    folds = rows.select("a", "b", "target", F.lit(1).alias("fold"), F.when(F.col("is_val"), "val").otherwise("train").alias("role"))
    got = {r.alpha: (r.rmse, r.mae, r.n_samples) for r in M.cv_ridge(folds, [0.01, 500.0], ["a", "b"]).collect()}
    for a, want in got.items():
        r = M.cv_linear(folds, ["a", "b"], alpha=a).first()
        assert np.allclose((r.rmse, r.mae, r.n_samples), want)
    assert got[0.01] != got[500.0]
