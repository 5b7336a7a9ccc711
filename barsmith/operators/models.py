"""Models on Spark ML (L1-L10) and the walk-forward AR(2) forecast of returns.

The reference's boosting library, pinball-loss boosters and TPE search are
re-aimed (see README): GBTRegressor for the p50 model, residual quantiles
for the p10/p90 band, a seeded random search over ridge strengths.
"""

from __future__ import annotations

import math
import random

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions.numeric import round_half_away
from barsmith.operators import sequence as S
from barsmith.operators.metrics import compute_metrics, cv_average
from barsmith.operators.scaling import apply_scaler, fit_standard
from barsmith.params import DEFAULT_FEATURES, DEFAULT_MODELS
from barsmith.session import materialize

FEATS = DEFAULT_FEATURES.feature_names()


def _assembler(features):
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def fit_linear(train: DataFrame, features=FEATS, label: str = "target") -> PipelineModel:
    """L1: least squares (normal equations), no penalty."""
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0)
    return Pipeline(stages=[_assembler(features), lr]).fit(train)


def fit_ridge(train: DataFrame, alpha: float = 1.0, features=FEATS, label: str = "target"):
    """L2: ridge on population-standardised X, intercept unpenalised.

    ``alpha`` is the reference's penalty on sum((y - Xw)^2) + alpha*|w|^2;
    MLlib minimises 1/(2n) sum(.)^2 + reg/2 |w|^2 with the label scaled by
    its std, so reg = alpha / n * std_pop(y).  Returns (scaler, model).
    """
    scaler = fit_standard(train, list(features))
    xs = apply_scaler(train, scaler, list(features))
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sy")).first()
    reg = alpha / st["n"] * (st["sy"] or 1.0)
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=reg,
                          elasticNetParam=0.0, standardization=False)
    return scaler, Pipeline(stages=[_assembler(features), lr]).fit(xs)


def fit_gbt(train: DataFrame, features=FEATS, label: str = "target", *, max_iter: int = DEFAULT_MODELS.n_estimators,
            step: float = 0.05, depth: int = 6, subsample: float = 0.8, colsample: str = "0.8",
            min_instances: int = 5, validation_col: str | None = None,
            patience: int = DEFAULT_MODELS.early_stopping_rounds, seed: int = 42) -> PipelineModel:
    """L4 re-aim: squared-error boosted trees.  With a validation indicator
    column, boosting ends after ``patience`` rounds without a smaller
    validation error; like the reference's booster the model keeps those rounds.

    Spark's own validation stops at the first round that gains less than a
    tolerance, so the rule is applied here: a round depends on earlier rounds
    only, hence the first rounds of a longer fit are those of a shorter one,
    and the fit is made longer until the rule ends it."""
    kw = dict(featuresCol="features", labelCol=label, lossType="squared", maxIter=max_iter, stepSize=step,
              maxDepth=depth, subsamplingRate=subsample, featureSubsetStrategy=colsample,
              minInstancesPerNode=min_instances, seed=seed)
    fit = lambda rows, n: Pipeline(stages=[_assembler(features), GBTRegressor(**{**kw, "maxIter": n})]).fit(rows)
    held = train.filter(F.col(validation_col)) if validation_col else None
    if held is None or held.isEmpty():
        return fit(train, max_iter)
    rows, n = train.filter(~F.col(validation_col)), min(max_iter, 2 * patience)
    while True:
        model = fit(rows, n)
        rounds = stopped_at(model.stages[-1].evaluateEachIteration(model.stages[0].transform(held), "squared"), patience)
        if rounds or n == max_iter:
            return first_rounds(model, rounds or n)
        n = min(max_iter, 2 * n)


def stopped_at(errors: list[float], patience: int) -> int | None:
    """The number of rounds after which ``patience`` rounds in a row were no
    better than the best before; None if that never happens."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return i + 1
    return None


def first_rounds(model: PipelineModel, n: int) -> PipelineModel:
    """The boosted model of the first ``n`` rounds."""
    full = model.stages[-1]
    if n >= full.getNumTrees:
        return model
    java, sc = full._java_obj, SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.regression
    trees = sc._gateway.new_array(kind.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(sc._gateway.jvm.double, n)
    for i in range(n):
        trees[i], weights[i] = java.trees()[i], full.treeWeights[i]
    cut = kind.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    return PipelineModel([*model.stages[:-1], GBTRegressionModel(cut)])


def score(model: PipelineModel, df: DataFrame, version: str, keys=("ticker", "date"),
          lower: Column | None = None, upper: Column | None = None) -> DataFrame:
    """Batch scoring; p50 rounded 6, fallback bounds, version."""
    p = model.transform(df)
    p50 = F.col("prediction")
    lo = lower if lower is not None else p50 * F.lit(0.9)
    hi = upper if upper is not None else p50 * F.lit(1.1)
    return p.select(*keys, round_half_away(p50, 6).alias("prediction"),
                    round_half_away(lo, 6).alias("lower_bound"), round_half_away(hi, 6).alias("upper_bound"),
                    F.lit(version).alias("model_version"))


def top_importances(model: PipelineModel, features=FEATS, k: int = 10) -> list[tuple[str, float]]:
    """The k largest (impurity-based) importances of a tree model."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, imp)), key=lambda t: -t[1])[:k]


def cv_linear(folds: DataFrame, features=FEATS, label: str = "target", alpha: float | None = None) -> DataFrame:
    """Fit on each fold's train rows, score its validation rows, A6 per
    fold, A7 average (folds are few: the loop runs on the driver, the work
    of each fit is distributed)."""
    n = [r[0] for r in folds.select("fold").distinct().orderBy("fold").collect()]
    per = []
    for f in n:
        tr = folds.filter((F.col("fold") == f) & (F.col("role") == "train"))
        va = folds.filter((F.col("fold") == f) & (F.col("role") == "val"))
        if alpha is None:
            pred = fit_linear(tr, features, label).transform(va)
        else:
            scaler, m = fit_ridge(tr, alpha, features, label)
            pred = m.transform(apply_scaler(va, scaler, list(features)))
        per.append(compute_metrics(pred, label, "prediction").withColumn("fold", F.lit(f)))
    out = per[0]
    for p in per[1:]:
        out = out.unionByName(p)
    return out


def cv_ridge(folds: DataFrame, alphas: list[float], features=FEATS, label: str = "target") -> DataFrame:
    """A6 per (alpha, fold) of the ridge fits that ``cv_linear`` makes for
    each alpha: a fold is scaled once, and its validation rows are scored by
    all of the fold's models in one pass."""
    out = None
    for f in [r[0] for r in folds.select("fold").distinct().orderBy("fold").collect()]:
        tr = folds.filter((F.col("fold") == f) & (F.col("role") == "train"))
        va = folds.filter((F.col("fold") == f) & (F.col("role") == "val"))
        scaler = materialize(fit_standard(tr, list(features)), "scaler")
        scaled = lambda d: _assembler(features).transform(apply_scaler(d, scaler, list(features))).select("features", label)  # noqa: E731,B023
        xs = materialize(scaled(tr), "scaled-fold")
        st = tr.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sy")).first()
        models = []
        for a in alphas:
            lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=a / st["n"] * (st["sy"] or 1.0),
                                  elasticNetParam=0.0, standardization=False)
            m = lr.fit(xs)
            models.append((a, float(m.intercept), [float(c) for c in m.coefficients]))
        fits = xs.sparkSession.createDataFrame(models, "alpha double, intercept double, weights array<double>")
        products = F.zip_with("x", "weights", lambda x, w: x * w)
        scored = (scaled(va).select(vector_to_array("features").alias("x"), label).crossJoin(F.broadcast(fits))  # one row an alpha
                  .withColumn("prediction", F.aggregate(products, F.col("intercept"), lambda s, p: s + p)))
        rows = compute_metrics(scored, label, "prediction", by=["alpha"]).withColumn("fold", F.lit(f))
        out = rows if out is None else out.unionByName(rows)
    return out


def param_search(folds: DataFrame, n_trials: int = DEFAULT_MODELS.n_trials, seed: int = 42, lo: float = 1e-4, hi: float = 10.0):
    """L9 re-aim: seeded log-uniform ridge strengths x walk-forward folds;
    the candidate with the smallest mean fold RMSE (``min_by``)."""
    rng = random.Random(seed)
    trials = [math.exp(rng.uniform(math.log(lo), math.log(hi))) for _ in range(n_trials)]
    rows = materialize(cv_average(cv_ridge(folds, trials), ["alpha"]), "trials")
    return rows, rows.agg(F.min_by("alpha", "rmse").alias("best_alpha"), F.min("rmse").alias("best_rmse"))


# ---------------------------------------------------------------------------
# Walk-forward AR(2) one-step forecast (refit on all history each step)
# ---------------------------------------------------------------------------
def ar2_forecast(bars: DataFrame, value: str = "close", by=("ticker",), order: str = "date", *,
                 returns: bool = True, min_obs: int = 30) -> DataFrame:
    """For every row t: fit x_s = c + a1 x_{s-1} + a2 x_{s-2} by least squares
    on all s < t whose three values exist, then forecast x_t.  x is the return
    on the row before (NULL where that is NULL or 0), or with ``returns=False``
    the value itself.

    The fit needs only running sums of products over the blocked layout,
    carried across blocks.  They are sums of deviations from a constant of the
    series near its mean, and the 2 x 2 system is in co-moments, so a level that
    is large against the noise does not cancel.  The forecast is NULL without
    both lags, for fewer than ``min_obs`` fitted rows, and where the lags are
    collinear (1 - r^2 <= 1e-9).  The MA term and the maximum-likelihood fit of
    the reference's ARIMA are not built."""
    by = list(by)
    src = bars.select(*by, order, value)
    d = S.blocked(S.with_ordinal(src, by, order), by, 4096, 3, 0)
    w = S.block_window(by)
    x = F.try_divide(F.col(value), F.lag(value, 1).over(w)) - 1 if returns else F.col(value)
    d = d.withColumn("_x", x.cast("double"))
    d = d.select("*", F.lag("_x", 1).over(w).alias("_x1"), F.lag("_x", 2).over(w).alias("_x2")).filter(F.col(S.HOME))
    if returns:    # the mean of returns is small against their spread
        d = d.withColumn("_s", F.lit(0.0))
    else:          # one row a series
        d = d.join(src.groupBy(*by).agg(F.coalesce(F.avg(value), F.lit(0.0)).alias("_s")), by)
    u, u1, u2 = (F.col(c) - F.col("_s") for c in ("_x", "_x1", "_x2"))
    ok = F.col("_x").isNotNull() & F.col("_x1").isNotNull() & F.col("_x2").isNotNull()
    terms = {"_n": F.lit(1.0), "_s1": u1, "_s2": u2, "_sy": u, "_s11": u1 * u1, "_s12": u1 * u2, "_s22": u2 * u2,
             "_s1y": u1 * u, "_s2y": u2 * u}
    d = d.select("*", *[F.when(ok, t).alias(k + "_t") for k, t in terms.items()])
    d = S.running_sums(d, {k + "_t": k for k in terms}, by)
    # sums over s < t: without the row's own term
    n, s1, s2, sy, s11, s12, s22, s1y, s2y = (F.col(k) - F.coalesce(F.col(k + "_t"), F.lit(0.0)) for k in terms)
    c11, c12, c22 = s11 - s1 * s1 / n, s12 - s1 * s2 / n, s22 - s2 * s2 / n
    c1y, c2y = s1y - s1 * sy / n, s2y - s2 * sy / n
    det = c11 * c22 - c12 * c12
    a1, a2 = (c1y * c22 - c2y * c12) / det, (c2y * c11 - c1y * c12) / det
    fc = F.col("_s") + sy / n + a1 * (u1 - s1 / n) + a2 * (u2 - s2 / n)
    fits = (n >= max(min_obs, 3)) & (det > 1e-9 * c11 * c22)
    return d.select(*by, order, value, F.when(n > 0, F.when(fits, fc)).alias("ar2_forecast"))
