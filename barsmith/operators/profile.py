"""Distribution profile of feature columns (A1, A2) = drift baseline.

One row per feature: mean, population std, min, max, p5/p25/p50/p75/p95
(linear), non-null count, and a 20-bin equal-width histogram
(``counts`` array<bigint>, ``bin_edges`` array<double>).  All moments and
histogram counts are mergeable aggregates; percentiles use
:func:`barsmith.operators.quantiles.exact_quantiles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.operators.quantiles import exact_quantiles, wide_quantiles

# The reference's stored percentiles 5, 25, 50, 75, 95.
PCTS = {0.05: "p5", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.95: "p95"}


def to_long(df: DataFrame, features: list[str], ids: list[str] | None = None) -> DataFrame:
    """Wide feature columns -> ``(ids..., feature, value)`` (nulls kept;
    NaN becomes NULL, the pandas-boundary rule: pandas ``dropna`` drops it)."""
    vals = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in features]
    return df.select(*(ids or []), *vals).unpivot(ids or [], features, "feature", "value")


def hist_edges(lo: Column, hi: Column, bins: int) -> Column:
    """numpy ``linspace`` edges over [lo, hi]; lo == hi widens to +-0.5."""
    same = lo == hi
    a = F.when(same, lo - F.lit(0.5)).otherwise(lo)
    b = F.when(same, hi + F.lit(0.5)).otherwise(hi)
    step = (b - a) / F.lit(float(bins))
    inner = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: a + i.cast("double") * step)
    return F.concat(inner, F.array(b))


def bin_index(x: Column, edges: Column, bins: int) -> Column:
    """Equal-width bin of ``x`` (right-open, last bin closed): number of
    edges 0..bins-1 that are <= x, minus one.  NULL outside [e0, e_last]."""
    inner = F.slice(edges, 1, bins)
    idx = F.size(F.filter(inner, lambda e: e <= x)) - 1
    inside = (x >= F.element_at(edges, 1)) & (x <= F.element_at(edges, -1))
    return F.when(inside, idx)


def baseline_stats(df: DataFrame, features: list[str], *, bins: int = 20,
                   space: str = "raw") -> DataFrame:
    """A1 + A2 over the wide frame ``df``.

    Output: feature, mean, std, min, max, p5..p95, n_samples, counts,
    bin_edges, n_train_samples (rows incl. nulls), space.  Features with
    no non-null value are skipped.
    """
    long = to_long(df, features).filter(F.col("value").isNotNull())
    mom = long.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count(F.lit(1)).alias("n_samples"))
    mom = mom.withColumn("bin_edges", hist_edges(F.col("min"), F.col("max"), bins))
    # histogram: join each value with its feature's edges (<= #features rows)
    hist = (long.join(F.broadcast(mom.select("feature", "bin_edges")), "feature")
                .withColumn("bin", bin_index(F.col("value"), F.col("bin_edges"), bins))
                .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("c")))
    grid = mom.select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    dense = (grid.join(hist, ["feature", "bin"], "left")
                 .groupBy("feature")
                 .agg(F.sort_array(F.collect_list(F.struct("bin", F.coalesce("c", F.lit(0)).alias("c"))))
                      .alias("_h"))
                 .select("feature", F.transform("_h", lambda s: s["c"]).alias("counts")))
    q = wide_quantiles(exact_quantiles(long, ["feature"], "value", list(PCTS)), ["feature"], PCTS)
    n_rows = df.agg(F.count(F.lit(1)).alias("n_train_samples"))
    return (mom.join(q, "feature").join(dense, "feature").crossJoin(n_rows)
               .select("feature", "mean", "std", "min", "max", *PCTS.values(), "n_samples",
                       "counts", "bin_edges", "n_train_samples", F.lit(space).alias("space")))
