"""Queries: Spark ML models and evaluation (L1-L10, A14, S20, W16) — rows-only
checks (model fits have no SQL twin), except the forecast and the naive parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from barsmith.functions.dates import version_tag
from barsmith.operators import intervals as I
from barsmith.operators import models as M
from barsmith.operators import splits as SP
from barsmith.operators.backtest import interval_fallback
from barsmith.operators.metrics import compute_metrics, cv_average, naive_mean
from barsmith.operators.scaling import apply_scaler
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, rounded
from barsmith.session import materialize
from barsmith.sources.bars import daily_bars


def _split(spark, sf_dir):
    """The split feature matrix, materialised once: every model fit and
    metric below reads it instead of recomputing the features."""
    from barsmith.plans.q_splits import _fm
    return materialize(SP.three_way_split(_fm(spark, sf_dir)), "split")


@query("model_ols")
def q_model_ols(spark, sf_dir):
    """L1: OLS fitted on train, A6 on validation and test."""
    d = _split(spark, sf_dir)
    m = M.fit_linear(d.filter(F.col("split") == "train"))
    return rounded(compute_metrics(m.transform(d.filter(F.col("split") != "train")), by=["split"]))


@query("model_ridge")
def q_model_ridge(spark, sf_dir):
    """L2: ridge (alpha 1) on population-standardised features."""
    d = _split(spark, sf_dir)
    scaler, m = M.fit_ridge(d.filter(F.col("split") == "train"), 1.0)
    scored = m.transform(apply_scaler(d.filter(F.col("split") != "train"), scaler, M.FEATS))
    return rounded(compute_metrics(scored, by=["split"]))


def _tv_folds(spark, sf_dir, d=None):
    d = d if d is not None else _split(spark, sf_dir)
    tv = d.filter(F.col("split") != "test").drop("split")
    return materialize(SP.walk_forward_folds(tv), "folds")


@query("baseline_eval")
def q_baseline_eval(spark, sf_dir):
    """L3: per model (naive mean, OLS, ridge): fold rows, the cv_avg row, the test row."""
    d = _split(spark, sf_dir)
    folds = _tv_folds(spark, sf_dir, d)
    train, test = d.filter(F.col("split") != "test"), d.filter(F.col("split") == "test")
    out = []
    # naive mean
    means = folds.filter(F.col("role") == "train").groupBy("fold").agg(F.avg("target").alias("prediction"))
    nf = compute_metrics(folds.filter(F.col("role") == "val").join(F.broadcast(means), "fold"), by=["fold"])
    nt = compute_metrics(test.crossJoin(F.broadcast(naive_mean(train))))
    out.append(("naive_mean", nf, nt))
    of = M.cv_linear(folds)
    ot = compute_metrics(M.fit_linear(train).transform(test))
    out.append(("ols", of, ot))
    rf = M.cv_linear(folds, alpha=1.0)
    scaler, rm = M.fit_ridge(train, 1.0)
    rt = compute_metrics(rm.transform(apply_scaler(test, scaler, M.FEATS)))
    out.append(("ridge", rf, rt))
    res = None
    for name, f, t in out:
        rows = (f.withColumn("split", F.concat(F.lit("fold_"), F.col("fold").cast("string"))).drop("fold")
                 .unionByName(cv_average(f.withColumn("split", F.lit("cv_avg")), ["split"]))
                 .unionByName(t.withColumn("split", F.lit("test")))
                 .withColumn("model", F.lit(name)))
        res = rows if res is None else res.unionByName(rows)
    return rounded(res)


def _boosted(full):
    """The boosted model of the train split, early stopping on the val split."""
    d = full.filter(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    return M.fit_gbt(d, validation_col="is_val")


@query("model_gbt")
def q_model_gbt(spark, sf_dir):
    """L4 re-aim: boosted trees (squared error), early stopping on the val split."""
    full = _split(spark, sf_dir)
    m = _boosted(full)
    test = full.filter(F.col("split") == "test")
    return rounded(compute_metrics(m.transform(test)).withColumn("model", F.lit("gbt")))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Top-10 importances of the boosted model."""
    top = M.top_importances(_boosted(_split(spark, sf_dir)))
    return rounded(spark.createDataFrame(top, "feature string, importance double"))


@query("batch_score")
def q_batch_score(spark, sf_dir):
    """The test split scored by the boosted model, with the band of its
    residuals on the val split (which also ends the boosting)."""
    d = _split(spark, sf_dir)
    m = _boosted(d)
    held = materialize(m.transform(d.filter(F.col("split") == "val")).select("ticker", "date", "target", "prediction"), "residuals")
    band = I.conformal_offsets(held)           # one row
    p50 = F.col("prediction")
    lower, upper = interval_fallback(p50)      # for a val split that is too small
    return M.score(m, d.filter(F.col("split") == "test").crossJoin(F.broadcast(band)), "stock-model-gbt",
                   lower=F.coalesce(p50 + F.col("lower_offset"), lower), upper=F.coalesce(p50 + F.col("upper_offset"), upper))


# ---- L5 band of a plain p50, in SQL too ------------------------------------------
def _conformal_sql() -> str:
    from barsmith.plans.q_splits import _g_ctes
    c = _g_ctes({
        "p50": "  SELECT avg(target) AS prediction FROM g3 WHERE split = 'train'",
        "res": """
  SELECT ticker, count(*) AS n_cal, list_sort(list(target - prediction)) AS r
  FROM g3 CROSS JOIN p50 WHERE split = 'val' GROUP BY ticker""",
        "band": """
  SELECT ticker, n_cal, prediction, prediction + r[NULLIF((n_cal + 1) * 100 // 1000, 0)] AS lo,
         prediction + r[((n_cal + 1) * 900 + 999) // 1000] AS hi
  FROM res CROSS JOIN p50""",
        "cov": """
  SELECT g3.ticker, count(*) AS n_rows,
         avg(CAST(coalesce(target >= lo, true) AND coalesce(target <= hi, true) AS DOUBLE)) AS coverage
  FROM g3 JOIN band ON g3.ticker = band.ticker WHERE split = 'test' GROUP BY g3.ticker"""})
    cols = ", ".join([R("prediction", "prediction"), R("lo", "lower_bound"), R("hi", "upper_bound"), R("coverage", "coverage")])
    return Q.cte(**c) + f"SELECT band.ticker, n_cal, {cols}, n_rows FROM band LEFT JOIN cov ON band.ticker = cov.ticker"


@query("interval_conformal", _conformal_sql)
def q_interval_conformal(spark, sf_dir):
    """Per ticker the band of a p50 (mean target of the train split) by its
    residuals on the val split, and how much of the test split it covers."""
    d = _split(spark, sf_dir)
    p50 = d.filter(F.col("split") == "train").agg(F.avg("target").alias("prediction"))   # one row
    d = d.crossJoin(F.broadcast(p50))
    band = materialize(I.conformal_offsets(d.filter(F.col("split") == "val"), ["ticker"]).crossJoin(F.broadcast(p50)).select(
        "ticker", "n_cal", "prediction", (F.col("prediction") + F.col("lower_offset")).alias("lower_bound"),
        (F.col("prediction") + F.col("upper_offset")).alias("upper_bound")), "band")
    test = d.filter(F.col("split") == "test").select("ticker", "target").join(band, "ticker")
    return rounded(band.join(I.coverage(test, ["ticker"]), "ticker", "left"))


@query("model_cv")
def q_model_cv(spark, sf_dir):
    """Walk-forward CV of OLS, averaged."""
    f = M.cv_linear(_tv_folds(spark, sf_dir))
    return rounded(cv_average(f.withColumn("model", F.lit("ols")), ["model"]))


@query("param_search")
def q_param_search(spark, sf_dir):
    """L9 re-aim: seeded random ridge strengths x folds; best by mean RMSE."""
    rows, best = M.param_search(_tv_folds(spark, sf_dir))
    return rounded(rows.crossJoin(best))


@query("train_summary")
def q_train_summary(spark, sf_dir):
    """One-row run artefact (test metrics and top-10 importances of the
    boosted model, cross-validation of OLS on the folds, version, row counts)
    and its JSON form."""
    d = _split(spark, sf_dir)
    counts = d.groupBy().pivot("split", ["train", "val", "test"]).count()
    m = _boosted(d)
    test = compute_metrics(m.transform(d.filter(F.col("split") == "test")))
    cv = cv_average(M.cv_linear(_tv_folds(spark, sf_dir, d)).withColumn("k", F.lit(1)), ["k"]).drop("k")
    top = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(v).alias("importance")) for f, v in M.top_importances(m)])
    version = F.concat(F.lit("stock-model-"), version_tag(F.lit(dt.datetime(2024, 1, 31)).cast("timestamp")))
    s = (test.select(F.struct(*test.columns).alias("test_metrics"))
         .crossJoin(cv.select(F.struct(*cv.columns).alias("cv_metrics")))
         .crossJoin(counts.select(F.struct("train", "val", "test").alias("n_rows")))
         .select(version.alias("model_version"), "cv_metrics", "test_metrics", top.alias("feature_importances"), "n_rows"))
    return s.withColumn("json", F.to_json(F.struct(*s.columns)))


def _ar2_sql() -> str:
    lags = """
  SELECT *, lag(r, 1) OVER w AS r1, lag(r, 2) OVER w AS r2 FROM (
    SELECT ticker, date, close, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS r FROM bars)
  WINDOW w AS (PARTITION BY ticker ORDER BY date)"""
    ok = "CASE WHEN r IS NOT NULL AND r1 IS NOT NULL AND r2 IS NOT NULL THEN {} END"
    co = """
  SELECT ticker, date, close, r1, r2, count(y) OVER w AS n, avg(y) OVER w AS my, avg(a) OVER w AS m1, avg(b) OVER w AS m2,
         var_pop(a) OVER w AS c11, var_pop(b) OVER w AS c22, covar_pop(a, b) OVER w AS c12,
         covar_pop(a, y) OVER w AS c1y, covar_pop(b, y) OVER w AS c2y
  FROM xs WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    det = "(c11 * c22 - c12 * c12)"
    fc = (f"CASE WHEN n >= 30 AND {det} > 1e-9 * c11 * c22 THEN my + (c1y * c22 - c2y * c12) / {det} * (r1 - m1) "
          f"+ (c2y * c11 - c1y * c12) / {det} * (r2 - m2) END")
    parts = {"bars": Q.BARS_D, "lags": lags,
             "xs": f"  SELECT *, {ok.format('r')} AS y, {ok.format('r1')} AS a, {ok.format('r2')} AS b FROM lags", "co": co}
    return Q.cte(**parts) + f"SELECT ticker, date, {R('close', 'close')}, {R(fc, 'ar2_forecast')} FROM co"


@query("ar2_forecast", _ar2_sql)
def q_ar2_forecast(spark, sf_dir):
    """W16 re-aim: walk-forward AR(2) one-step forecasts of the daily return."""
    return rounded(M.ar2_forecast(daily_bars(spark, sf_dir)))
