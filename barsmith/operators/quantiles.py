"""Exact per-key quantiles without gathering a key's values in one task.

Spark's exact ``percentile`` keeps a value->count map per group, so the
final merge for one key holds every distinct value of that key.  Here:

1. equal values are counted first (combined before the shuffle), so a value
   that holds most of a key is one row;
2. every key's values are cut into ``BUCKETS`` buckets at approximate
   quantiles; the cuts are data - a small table that is written once - so
   every branch of the plan that computes a row's bucket agrees on it, however
   often it is computed;
3. per (key, bucket) totals give each bucket's first rank, a window inside the
   bucket each value's ranks;
4. only the ranks that the requested probabilities need are kept and
   interpolated.

Linear interpolation matches numpy / DuckDB ``quantile_cont``:
h = (n-1)p, q = v[floor h] + (v[ceil h] - v[floor h]) * (h - floor h).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.session import materialize

BUCKETS = 64


def running(counted: DataFrame, keys: list[str], value: str, counts: list[str]) -> DataFrame:
    """``counted`` (one row per key and value) with, for each count column c,
    ``c_before`` (its sum over the key's smaller values) and ``c_all`` (over
    all the key's values)."""
    probs = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    cuts = counted.groupBy(*keys).agg(F.percentile_approx(value, probs, F.lit(4 * BUCKETS)).alias("_cuts"))
    cuts = materialize(cuts, "value-cuts")
    d = counted.join(cuts, keys).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    totals = d.groupBy(*keys, "_b").agg(*[F.sum(c).alias(f"{c}_t") for c in counts])
    over_b = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_b", *[F.coalesce(F.sum(f"{c}_t").over(over_b), F.lit(0)).alias(f"{c}_off") for c in counts],
                           *[F.sum(f"{c}_t").over(Window.partitionBy(*keys)).alias(f"{c}_all") for c in counts])
    inside = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    d = d.select(*keys, value, *counts, "_b", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_in") for c in counts])
    d = d.join(totals, [*keys, "_b"])      # at most BUCKETS rows per key
    return d.select(*keys, value, *counts, *[(F.col(f"{c}_off") + F.col(f"{c}_in")).alias(f"{c}_before") for c in counts],
                    *[f"{c}_all" for c in counts])


def ranked(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key and distinct non-null value: ``_first`` and ``_last``
    (0-based ranks of the equal values) and ``_n`` (values of the key)."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    return running(counted, keys, value, ["_c"]).select(
        *keys, value, F.col("_c_before").alias("_first"), (F.col("_c_before") + F.col("_c") - 1).alias("_last"),
        F.col("_c_all").alias("_n"))


def _holds(rank: Column) -> Column:
    return (F.col("_first") <= rank) & (rank <= F.col("_last"))


def _one_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(keys)) if keys else (df.withColumn("_key", F.lit(0)), ["_key"])


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs) -> DataFrame:
    """Long result ``keys..., p, q`` (linear interpolation)."""
    d, by = _one_key(df, keys)
    r = ranked(d, by, value).withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    h = (F.col("_n") - 1).cast("double") * F.col("p")
    lo, hi = F.floor(h), F.ceil(h)
    g = r.filter(_holds(lo) | _holds(hi)).withColumn("_frac", h - lo).groupBy(*by, "p").agg(
        F.max(F.when(_holds(lo), F.col(value))).alias("_lo"),
        F.max(F.when(_holds(hi), F.col(value))).alias("_hi"),
        F.first("_frac").alias("_frac"))
    return g.select(*keys, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("q"))


def rank_select(df: DataFrame, keys: list[str], value: str, probs) -> DataFrame:
    """Non-interpolated ``sorted(v)[int(n * p)]`` per key (``keys..., p, q``)."""
    d, by = _one_key(df, keys)
    r = ranked(d, by, value).withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    pos = F.least(F.floor(F.col("_n").cast("double") * F.col("p")), F.col("_n") - 1)
    return r.filter(_holds(pos)).groupBy(*by, "p").agg(F.max(value).alias("q")).select(*keys, "p", "q")


def wide_quantiles(long_q: DataFrame, keys: list[str], names: dict[float, str]) -> DataFrame:
    """Pivot ``keys, p, q`` to one column per probability."""
    aggs = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(n) for p, n in names.items()]
    return long_q.groupBy(*keys).agg(*aggs)
