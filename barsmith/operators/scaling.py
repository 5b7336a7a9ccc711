"""Scalers fitted on a training frame (M4-M6).

:class:`ColumnScaler` is the pipeline stage: an Estimator over columns, fitted by
exact distributed quantiles (or moments), whose model holds one centre and scale
a column as parameters, so a pipeline with it is saved and loaded by Spark ML.
The functions below it are its parts.  There a fitted scaler is a tiny table ``(feature, center, scale)`` — one row per
feature — so applying it is a broadcast of a schema-sized table, and
persisting it is a parquet write (the reference pickles it).
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.operators.profile import to_long
from barsmith.operators.quantiles import exact_quantiles, wide_quantiles


def fit_robust(train: DataFrame, features: list[str]) -> DataFrame:
    """M4: center = median, scale = q75 - q25 (exact, linear); 0 -> 1."""
    long = to_long(train, features).filter(F.col("value").isNotNull())
    q = wide_quantiles(exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75]), ["feature"],
                       {0.25: "q25", 0.5: "q50", 0.75: "q75"})
    iqr = F.col("q75") - F.col("q25")
    return q.select("feature", F.col("q50").alias("center"),
                    F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def fit_standard(train: DataFrame, features: list[str]) -> DataFrame:
    """M5: center = mean, scale = population std; 0 -> 1."""
    long = to_long(train, features).filter(F.col("value").isNotNull())
    g = long.groupBy("feature").agg(F.avg("value").alias("center"), F.stddev_pop("value").alias("sd"))
    return g.select("feature", "center",
                    F.when(F.col("sd") == 0, F.lit(1.0)).otherwise(F.col("sd")).alias("scale"))


def apply_scaler(df: DataFrame, scaler: DataFrame, features: list[str]) -> DataFrame:
    """(x - center) / scale for every feature; other columns unchanged.

    The scaler is pivoted to ONE row and cross-joined (broadcast), so the
    big frame is never shuffled.
    """
    one = scaler.agg(*[
        F.struct(F.max(F.when(F.col("feature") == f, F.col("center"))).alias("c"),
                 F.max(F.when(F.col("feature") == f, F.col("scale"))).alias("s")).alias(f"_sc_{f}")
        for f in features])
    d = df.crossJoin(F.broadcast(one))
    out = [((F.col(f) - F.col(f"_sc_{f}.c")) / F.col(f"_sc_{f}.s")).alias(f) if f in features else F.col(f)
           for f in df.columns]
    return d.select(*out)


def save_scaler(scaler: DataFrame, path: str) -> None:
    """M6: persist the fitted parameters (a small parquet table)."""
    scaler.coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class _Method(HasInputCols):
    method = Param(Params._dummy(), "method", "robust (median, quartile range) or standard (mean, population deviation)", TypeConverters.toString)

    def getMethod(self) -> str:
        return self.getOrDefault(self.method)


class ColumnScaler(Estimator, _Method, DefaultParamsReadable, DefaultParamsWritable):
    """Fits centre and scale of ``inputCols``; a scale of 0 counts as 1, a
    column without values gets centre 0 and scale 1."""

    @keyword_only
    def __init__(self, *, inputCols=None, method="robust"):
        super().__init__()
        self._setDefault(method="robust")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ColumnScalerModel:
        cols, method = self.getInputCols(), self.getMethod()
        fits = {"robust": fit_robust, "standard": fit_standard}
        if method not in fits:
            raise ValueError(f"method must be one of {sorted(fits)}, not {method!r}")
        found = {r["feature"]: (r["center"], r["scale"]) for r in fits[method](dataset, cols).collect()}  # one row a column
        centers, scales = zip(*(found.get(c, (0.0, 1.0)) for c in cols), strict=True)
        return ColumnScalerModel(inputCols=cols, method=method, centers=[float(c) for c in centers], scales=[float(x) for x in scales])


class ColumnScalerModel(Model, _Method, DefaultParamsReadable, DefaultParamsWritable):
    """Scales its columns in place, (x - center) / scale; other columns and
    NULLs stay.  A projection: no join, no shuffle."""

    centers = Param(Params._dummy(), "centers", "centre of each input column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "scale of each input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, method=None, centers=None, scales=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def parameters(self, spark: SparkSession) -> DataFrame:
        """(feature, center, scale), as :func:`fit_robust` gives."""
        rows = list(zip(self.getInputCols(), self.getOrDefault(self.centers), self.getOrDefault(self.scales), strict=True))
        return spark.createDataFrame(rows, "feature string, center double, scale double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        by = dict(zip(self.getInputCols(), zip(self.getOrDefault(self.centers), self.getOrDefault(self.scales), strict=True), strict=True))
        return dataset.select(*[((F.col(c) - F.lit(by[c][0])) / F.lit(by[c][1])).alias(c) if c in by else F.col(c) for c in dataset.columns])
