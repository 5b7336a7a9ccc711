"""Queries: splits / folds (M1-M3), scaling (M4-M6), metrics."""

from __future__ import annotations

import os
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from barsmith.operators import splits as SP
from barsmith.operators.features import feature_matrix
from barsmith.operators.metrics import compute_metrics, cv_average, naive_mean
from barsmith.operators.scaling import ColumnScaler, fit_robust, fit_standard
from barsmith.params import DEFAULT_FEATURES as P, DEFAULT_SPLITS as S
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, rounded
from barsmith.session import checkpoint_dir, materialize
from barsmith.sources.bars import bar_table

TEST_FRAC = 1.0 - S.test_size          # the same double on both sides
FEATS = P.feature_names()


def _fm(spark, sf_dir):
    """The feature matrix for splits: its windowed rows are a written table
    (``write_once``), so the several branches that number the rows (day
    counts, month offsets, rows) re-read it instead of recomputing the
    windows."""
    return feature_matrix(bar_table(spark, sf_dir), write_once=True)


def _g_ctes(extra: dict | None = None) -> dict:
    c = Q.feature_ctes()
    c["g"] = """
  SELECT *, row_number() OVER (ORDER BY date, ticker) - 1 AS ord, count(*) OVER () AS n FROM fm"""
    c["g3"] = f"""
  SELECT *, CASE WHEN ord < floor(floor(n * {TEST_FRAC!r}) * {S.val_fraction!r}) THEN 'train'
                 WHEN ord < floor(n * {TEST_FRAC!r}) THEN 'val' ELSE 'test' END AS split FROM g"""
    c.update(extra or {})
    return c


def _folds_sql(src: str) -> str:
    s = S.n_splits
    return f"""
  SELECT x.*, f.fold,
         CASE WHEN x.ord >= x.n - ({s + 1} - f.fold) * floor(x.n / {s + 1})
                   AND x.ord < x.n - ({s + 1} - f.fold) * floor(x.n / {s + 1}) + floor(x.n / {s + 1}) THEN 'val'
              WHEN x.ord < x.n - ({s + 1} - f.fold) * floor(x.n / {s + 1}) - {S.gap} THEN 'train' END AS role
  FROM {src} x, range(1, {s + 1}) f(fold)"""


# ---- M1 / M2 ------------------------------------------------------------------
@query("temporal_split", lambda: Q.cte(**_g_ctes()) + f"""
SELECT ticker, date, CASE WHEN ord < floor(n * {TEST_FRAC!r}) THEN 'train' ELSE 'test' END AS split FROM g""")
def q_temporal_split(spark, sf_dir):
    return SP.temporal_split(_fm(spark, sf_dir)).select("ticker", "date", "split")


@query("three_way_split", lambda: Q.cte(**_g_ctes()) + "SELECT ticker, date, split FROM g3")
def q_three_way_split(spark, sf_dir):
    return SP.three_way_split(_fm(spark, sf_dir)).select("ticker", "date", "split")


# ---- M3 -----------------------------------------------------------------------
def _wf_sql(select: str, tail: str = "") -> str:
    c = _g_ctes({"wf0": _folds_sql("g"), "wf": "  SELECT * FROM wf0 WHERE role IS NOT NULL"})
    return Q.cte(**c) + f"SELECT {select} FROM wf {tail}"


@query("walk_forward_folds", lambda: _wf_sql("fold, role, ticker, date, " + R("target", "target")))
def q_walk_forward_folds(spark, sf_dir):
    f = SP.walk_forward_folds(_fm(spark, sf_dir))
    return rounded(f.select("fold", "role", "ticker", "date", "target"))


@query("fold_summary", lambda: _wf_sql(
    "fold, role, count(*) AS n_rows, min(date) AS start_date, max(date) AS end_date", "GROUP BY fold, role"))
def q_fold_summary(spark, sf_dir):
    return SP.fold_summary(SP.walk_forward_folds(_fm(spark, sf_dir)))


@query("walk_forward_folds_dates", lambda: Q.cte(**_g_ctes({
    "gd": """
  SELECT f.*, d.ord, d.n FROM fm f JOIN (
    SELECT date, row_number() OVER (ORDER BY date) - 1 AS ord, count(*) OVER () AS n
    FROM (SELECT DISTINCT date FROM fm)) d ON f.date = d.date""",
    "wf0": _folds_sql("gd")})) + """
SELECT fold, role, count(*) AS n_rows, min(date) AS start_date, max(date) AS end_date
FROM wf0 WHERE role IS NOT NULL GROUP BY fold, role""")
def q_walk_forward_folds_dates(spark, sf_dir):
    """M3 with ``unit="dates"``: positions are distinct dates, so the gap is
    in days and no date straddles train and validation (leak-safe)."""
    from dataclasses import replace
    f = SP.walk_forward_folds(_fm(spark, sf_dir), replace(S, unit="dates"))
    return SP.fold_summary(f)


# ---- M4 / M5 --------------------------------------------------------------------
def _train_long_sql():
    return "\n  UNION ALL\n".join(f"  SELECT '{f}' AS feature, {f} AS v FROM g3 WHERE split = 'train'"
                                  for f in FEATS)


@query("robust_scale", lambda: Q.cte(**_g_ctes({"tl": _train_long_sql()})) + """
SELECT feature, """ + R("q50", "center") + ", " + R(
    "CASE WHEN q75 - q25 = 0 THEN 1.0 ELSE q75 - q25 END", "scale") + """ FROM (
  SELECT feature, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75
  FROM tl WHERE v IS NOT NULL GROUP BY feature)""")
def q_robust_scale(spark, sf_dir):
    train = SP.three_way_split(_fm(spark, sf_dir)).filter(F.col("split") == "train")
    return rounded(fit_robust(train, FEATS))


@query("standard_scale", lambda: Q.cte(**_g_ctes({"tl": _train_long_sql()})) + """
SELECT feature, """ + R("avg(v)", "center") + ", " + R(
    "CASE WHEN stddev_pop(v) = 0 THEN 1.0 ELSE stddev_pop(v) END", "scale") + """
FROM tl WHERE v IS NOT NULL GROUP BY feature""")
def q_standard_scale(spark, sf_dir):
    train = SP.three_way_split(_fm(spark, sf_dir)).filter(F.col("split") == "train")
    return rounded(fit_standard(train, FEATS))


def _scaled_sql(tail: str) -> str:
    quartiles = ", ".join(f"quantile_cont({f}, 0.5) AS c_{f}, CASE WHEN quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) = 0 THEN 1.0 "
                          f"ELSE quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) END AS s_{f}" for f in FEATS)
    cols = ", ".join(R(f"({f} - c_{f}) / s_{f}", f) for f in FEATS)
    return Q.cte(**_g_ctes({"sc": f"  SELECT {quartiles} FROM g3 WHERE split = 'train'"})) + \
        f"SELECT ticker, date, split, {cols}, {R('target', 'target')} FROM g3, sc {tail}"


def _fitted_pipeline(d):
    """The robust scaler of the training split, as a Spark ML pipeline."""
    return Pipeline(stages=[ColumnScaler(inputCols=FEATS)]).fit(d.filter(F.col("split") == "train"))


@query("scaled_matrix", lambda: _scaled_sql(""))
def q_scaled_matrix(spark, sf_dir):
    """M4 applied: all rows of the train, validation and test splits, scaled
    by the training split's median and quartile range."""
    d = materialize(SP.three_way_split(_fm(spark, sf_dir)), "split")
    return rounded(_fitted_pipeline(d).transform(d).select("ticker", "date", "split", *FEATS, "target"))


@query("scaler_roundtrip", lambda: _scaled_sql("WHERE split = 'test'"))
def q_scaler_roundtrip(spark, sf_dir):
    """M6: the fitted pipeline is saved under the shared folder and loaded
    again; the loaded one scales the test split."""
    d = materialize(SP.three_way_split(_fm(spark, sf_dir)), "split")
    path = os.path.join(checkpoint_dir(spark), f"scaler-{uuid.uuid4().hex[:12]}")
    _fitted_pipeline(d).write().save(path)
    test = PipelineModel.load(path).transform(d.filter(F.col("split") == "test"))
    return rounded(test.select("ticker", "date", "split", *FEATS, "target"))


# ---- A13 / A6 / A7 -------------------------------------------------------------------
def _metric_sql(y: str, p: str, r) -> str:
    return ", ".join([
        f"{r(f'sqrt(avg(({y} - {p}) * ({y} - {p})))', 6)} AS rmse",
        f"{r(f'avg(abs({y} - {p}))', 6)} AS mae",
        f"{r(f'avg(CASE WHEN {y} <> 0 THEN abs(({y} - {p}) / {y}) END) * 100.0', 4)} AS mape",
        f"{r(f'avg(CAST(sign({y}) = sign({p}) AS DOUBLE))', 4)} AS directional_accuracy",
        f"{r(f'CASE WHEN stddev_pop(sign({p}) * {y}) > 0 THEN avg(sign({p}) * {y}) / stddev_pop(sign({p}) * {y}) * sqrt(252.0) END', 4)} AS sharpe_proxy",
        "count(*) AS n_samples"])


def _r(expr, d):
    from barsmith.plans.registry import sql_round
    return sql_round(expr, d)


@query("naive_mean", lambda: Q.cte(**_g_ctes()) +
       "SELECT " + R("avg(target)", "prediction") + " FROM g3 WHERE split = 'train'")
def q_naive_mean(spark, sf_dir):
    train = SP.three_way_split(_fm(spark, sf_dir)).filter(F.col("split") == "train")
    return rounded(naive_mean(train))


@query("eval_metrics", lambda: Q.cte(**_g_ctes({
    "nm": "  SELECT avg(target) AS prediction FROM g3 WHERE split = 'train'"})) +
       "SELECT split, " + _metric_sql("target", "prediction", _r) +
       " FROM g3, nm WHERE split IN ('val', 'test') GROUP BY split")
def q_eval_metrics(spark, sf_dir):
    """A6 of the naive-mean model on the validation and test splits."""
    d = SP.three_way_split(_fm(spark, sf_dir))
    nm = naive_mean(d.filter(F.col("split") == "train"))
    scored = d.filter(F.col("split").isin("val", "test")).crossJoin(F.broadcast(nm))
    return rounded(compute_metrics(scored, by=["split"]))


def _cv_sql():
    c = _g_ctes({
        "tv": f"""
  SELECT ticker, date, target, ord, count(*) OVER () AS n FROM g WHERE ord < floor(n * {TEST_FRAC!r})""",
        "wf0": _folds_sql("tv"),
        "fm_train": "  SELECT fold, avg(target) AS prediction FROM wf0 WHERE role = 'train' GROUP BY fold",
        "fold_m": "  SELECT w.fold, " + _metric_sql("w.target", "t.prediction", _r) + """
  FROM wf0 w JOIN fm_train t ON w.fold = t.fold WHERE w.role = 'val' GROUP BY w.fold""",
    })
    cols = ["rmse", "mae", "mape", "directional_accuracy", "sharpe_proxy", "n_samples"]
    return Q.cte(**c) + "SELECT 'naive_mean' AS model, " + ", ".join(
        f"{_r(f'avg({m})', 6)} AS {m}" for m in cols) + " FROM fold_m"


@query("cv_average", _cv_sql)
def q_cv_average(spark, sf_dir):
    """Naive-mean model, walk-forward folds over train+val, averaged."""
    tv = SP.three_way_split(_fm(spark, sf_dir)).filter(F.col("split") != "test").drop("split")
    folds = SP.walk_forward_folds(tv)
    means = folds.filter(F.col("role") == "train").groupBy("fold").agg(F.avg("target").alias("prediction"))
    val = folds.filter(F.col("role") == "val").join(F.broadcast(means), "fold")  # s rows
    fm = compute_metrics(val, by=["fold"])
    return rounded(cv_average(fm.withColumn("model", F.lit("naive_mean")), ["model"]))
