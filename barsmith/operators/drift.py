"""Drift of live feature values against a histogram baseline (K1-K6).

The baseline stores, per feature, a 20-bin histogram; the reference
re-expands it to samples (bin mid-points repeated by count).  Here the
mid-points stay weighted and the live side is reduced to counts in ONE
mergeable aggregation per (feature, slot), so the check scales with the
live data and also runs as a streaming aggregate:

* KS: the baseline ECDF only steps at the mid-points m_1 < ... < m_K, so
  sup |F_b - F_l| = max_k max(|B_k - L(<= m_k)|, |B_{k-1} - L(< m_k)|),
  which needs live counts per "number of mid-points below x" slot plus
  "x equals a mid-point" counts.  p-value: :func:`ks_pvalue`.
* PSI: edges = distinct linear percentiles 0,10..100 of the weighted
  mid-points (exact weighted ranks over <= 20 values); live
  values outside the edges count in the denominator only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from barsmith.functions.ksdist import exact_p
from barsmith.operators.quantiles import running
from barsmith.params import DriftParams, DEFAULT_DRIFT


def baseline_midpoints(baseline: DataFrame) -> DataFrame:
    """(feature, mids, counts, n_b) — mid-points weighted by counts."""
    e = F.col("bin_edges")
    n = F.size(e) - 1
    mids = F.zip_with(F.slice(e, 1, n), F.slice(e, 2, n), lambda a, b: (a + b) / F.lit(2.0))
    return baseline.select(
        "feature", mids.alias("mids"), F.col("counts"),
        F.aggregate("counts", F.lit(0).cast("long"), lambda acc, c: acc + c).alias("n_b"))


def psi_edges(mids: DataFrame, params: DriftParams = DEFAULT_DRIFT) -> DataFrame:
    """(feature, edges): distinct linear percentiles 0..100 (step
    100/bins) of the mid-points repeated by their counts, computed on the
    baseline row itself (<= 20 weighted values, no aggregation)."""
    probs = [i / params.psi_bins for i in range(params.psi_bins + 1)]
    K = F.size("mids")
    cum = F.transform(F.sequence(F.lit(1), K),
                      lambda k: F.aggregate(F.slice("counts", 1, k), F.lit(0).cast("long"),
                                            lambda a, c: a + c))

    def at(r: Column) -> Column:        # value of the r-th (0-based) sample
        return F.element_at("mids", F.size(F.filter("_cum", lambda c: c <= r)) + 1)

    def q(p: Column) -> Column:
        h = (F.col("n_b") - 1).cast("double") * p
        lo, hi = F.floor(h), F.ceil(h)
        return at(lo) + (at(hi) - at(lo)) * (h - lo)

    d = mids.filter(F.col("n_b") > 0).withColumn("_cum", cum)
    ps = F.array(*[F.lit(p) for p in probs])
    return d.select("feature", F.array_distinct(F.transform(ps, q)).alias("edges"))


def _psi_bin(x: Column, edges: Column) -> Column:
    """np.histogram bin of x over ``edges`` (last bin closed); NULL outside."""
    ne = F.size(edges)
    idx = F.size(F.filter(F.slice(edges, 1, ne - 1), lambda e: e <= x)) - 1
    inside = (x >= F.element_at(edges, 1)) & (x <= F.element_at(edges, -1))
    return F.when((ne >= 2) & inside, idx)


def drift_reference(baseline: DataFrame, params: DriftParams = DEFAULT_DRIFT) -> DataFrame:
    """(feature, mids, counts, n_b, edges): one row per baseline feature."""
    mid = baseline_midpoints(baseline)
    return mid.join(psi_edges(mid, params), "feature", "left")


def live_slot_counts(ref: DataFrame, live_long: DataFrame, by=()) -> DataFrame:
    """Live side of K1/K2 as ONE mergeable aggregation (also a valid
    streaming aggregation): counts per (by..., feature, j, eq, b) where j =
    mid-points below the value, eq = value equals a mid-point, b = PSI bin."""
    by = list(by)
    # one row per feature (bounded by the schema): broadcast to the live rows
    live = live_long.join(F.broadcast(ref), "feature")
    x = F.col("value")
    # NULL values keep their feature present: a slot of count 0
    return live.select(
        *by, "feature", "value",
        F.when(x.isNotNull(), F.size(F.filter("mids", lambda m: m < x))).alias("j"),
        F.exists("mids", lambda m: m == x).alias("eq"),
        _psi_bin(x, F.col("edges")).alias("b"),
    ).groupBy(*by, "feature", "j", "eq", "b").agg(F.count("value").alias("c"))


def drift_features(baseline: DataFrame, live_long: DataFrame,
                   params: DriftParams = DEFAULT_DRIFT, by=(), live_columns: list[str] | None = None) -> DataFrame:
    """K3: per feature ks_statistic, ks_p_value, ks_drifted, psi, psi_severity.

    ``live_long``: (by..., feature, value) — ``by`` keys (e.g. a time
    window) give one result per (key, feature) from the same single
    aggregation.  Features absent from the live data are skipped (F7); NULL
    live values are dropped per feature (F8), and a feature that is left
    without values stays, as not drifted.  ``live_columns`` names the features
    that exist as live columns, for a live window without any rows.
    """
    ref = drift_reference(baseline, params)
    slots = live_slot_counts(ref, live_long, by)
    if live_columns is not None:
        if by:
            raise ValueError("live_columns is for one window")
        exist = ref.filter(F.col("feature").isin(*live_columns)).select("feature")
        slots = slots.unionByName(exist.withColumn("c", F.lit(0).cast("long")), allowMissingColumns=True)
    return drift_from_slots(slots, ref, params, by)


def drift_from_slots(slots: DataFrame, ref: DataFrame, params: DriftParams = DEFAULT_DRIFT,
                     by=()) -> DataFrame:
    """KS / PSI / severity from live slot counts (small) and the reference."""
    by = list(by)
    per = slots.groupBy(*by, "feature").agg(
        F.collect_list(F.struct("j", "eq", "b", "c")).alias("s"),   # <= 2*21*11 slots
        F.sum("c").alias("n_l"))
    d = per.join(F.broadcast(ref), "feature")

    # ---- KS over the K mid-points --------------------------------------------
    K = F.size("mids")
    nb = F.col("n_b").cast("double")
    nl = F.greatest(F.col("n_l"), F.lit(1)).cast("double")   # 0 is a small sample below
    cum_b = F.transform(F.sequence(F.lit(1), K),
                        lambda k: F.aggregate(F.slice("counts", 1, k), F.lit(0).cast("long"),
                                              lambda a, c: a + c))

    def live_le(k):   # live values <= m_k  (fewer than k mids strictly below)
        return F.aggregate(F.filter("s", lambda t: t["j"] <= k - 1), F.lit(0).cast("long"),
                           lambda a, t: a + t["c"])

    def live_eq(k):   # live values == m_k
        return F.aggregate(F.filter("s", lambda t: (t["j"] == k - 1) & t["eq"]),
                           F.lit(0).cast("long"), lambda a, t: a + t["c"])

    seq = F.sequence(F.lit(1), K)
    d = (d.withColumn("_cb", cum_b)
          .withColumn("_lle", F.transform(seq, live_le))
          .withColumn("_leq", F.transform(seq, live_eq)))
    el = F.element_at
    gaps = F.transform(
        seq,
        lambda k: F.greatest(
            F.abs(el("_cb", k) / nb - el("_lle", k) / nl),
            F.abs(F.when(k > 1, el("_cb", F.greatest(k - 1, F.lit(1)))).otherwise(F.lit(0)) / nb
                  - (el("_lle", k) - el("_leq", k)) / nl)))
    D = F.array_max(gaps)
    small = F.col("n_l") < params.min_feature_samples
    ks_stat = F.when(small, F.lit(0.0)).otherwise(D)
    d = d.withColumn("_d", D)            # for the p-value of the last step

    # ---- PSI -------------------------------------------------------------------
    nbins = F.size("edges") - 1
    b_cnt = F.transform(
        F.sequence(F.lit(0), F.greatest(nbins - 1, F.lit(0))),
        lambda i: F.aggregate(
            F.filter(F.arrays_zip("mids", "counts"),
                     lambda z: _psi_bin(z["mids"], F.col("edges")) == i),
            F.lit(0).cast("long"), lambda a, z: a + z["counts"]))
    l_cnt = F.transform(
        F.sequence(F.lit(0), F.greatest(nbins - 1, F.lit(0))),
        lambda i: F.aggregate(F.filter("s", lambda t: t["b"] == i), F.lit(0).cast("long"),
                              lambda a, t: a + t["c"]))
    clip = F.lit(params.psi_clip)
    terms = F.zip_with(b_cnt, l_cnt, lambda b, c: (
        (F.greatest(c / nl, clip) - F.greatest(b / nb, clip))
        * F.log(F.greatest(c / nl, clip) / F.greatest(b / nb, clip))))
    psi_raw = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    psi = F.when(small | (F.size("edges") < 2) | F.col("edges").isNull(), F.lit(0.0)).otherwise(psi_raw)

    out = d.select(*by, "feature", ks_stat.alias("ks_statistic"), psi.alias("psi"), "_d", "n_l", "n_b", small.alias("_small"))
    out = out.withColumn("ks_p_value", F.when(F.col("_small"), F.lit(1.0)).otherwise(
        ks_pvalue(F.col("_d"), F.col("n_b"), nl, params)))
    return out.select(
        *by, "feature", "ks_statistic", "ks_p_value",
        (F.col("ks_p_value") < params.ks_alpha).alias("ks_drifted"),
        "psi", psi_severity(F.col("psi"), params).alias("psi_severity"))


def psi_severity(psi: Column, params: DriftParams = DEFAULT_DRIFT) -> Column:
    """< 0.1 stable, < 0.2 investigate, else severe."""
    return (F.when(psi < params.psi_stable, "stable")
             .when(psi < params.psi_investigate, "investigate").otherwise("severe"))


def drift_report(features: DataFrame, n_live: DataFrame, n_baseline: DataFrame,
                 params: DriftParams = DEFAULT_DRIFT, by=()) -> DataFrame:
    """One row (per ``by`` key).  ``n_live``: (by..., n_live_samples);
    ``n_baseline``: one row with ``n_baseline_samples``."""
    by = list(by)
    agg = features.groupBy(*by).agg(
        F.count_if("ks_drifted").alias("n_features_drifted"),
        F.count(F.lit(1)).alias("_nf"),
        F.max("psi").alias("_max_psi"))
    frac = F.when(F.col("_nf") > 0, F.col("n_features_drifted") / F.col("_nf")).otherwise(F.lit(0.0))
    r = agg.select(
        *by, "n_features_drifted",
        frac.alias("drift_fraction"),
        F.coalesce("_max_psi", F.lit(0.0)).alias("max_psi"))
    r = r.withColumn("overall_drift_detected", F.col("drift_fraction") >= params.drift_fraction_threshold)
    r = r.withColumn("trigger_retraining",
                     (F.col("max_psi") >= params.psi_investigate) | F.col("overall_drift_detected"))
    r = r.join(n_live, by) if by else r.crossJoin(n_live)
    return r.crossJoin(n_baseline)


def report_json(report: DataFrame, features: DataFrame, ts: Column) -> DataFrame:
    """The report as one JSON document (floats rounded to 4)."""
    f = features.agg(F.sort_array(F.collect_list(F.struct(
        "feature", F.round("ks_statistic", 4).alias("ks_statistic"),
        F.round("ks_p_value", 4).alias("ks_p_value"), "ks_drifted",
        F.round("psi", 4).alias("psi"), "psi_severity"))).alias("features"))
    doc = report.crossJoin(f).select(F.to_json(F.struct(
        ts.alias("timestamp"), "overall_drift_detected", "trigger_retraining",
        F.round("drift_fraction", 4).alias("drift_fraction"), "n_features_drifted",
        F.round("max_psi", 4).alias("max_psi"), "n_live_samples", "n_baseline_samples",
        "features")).alias("json"))
    return doc


@F.pandas_udf(DoubleType())
def _exact_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    rows = pd.DataFrame({"d": d, "n": n, "m": m})
    known = rows.dropna()
    return pd.Series([exact_p(*r) for r in known.itertuples(index=False)], index=known.index, dtype="float64").reindex(rows.index)


def ks_pvalue(d: Column, n: Column, m: Column, params: DriftParams = DEFAULT_DRIFT) -> Column:
    """Two-sided KS p-value: the finite-sample distribution where both samples
    have at most ``params.ks_exact_max`` values, else the asymptotic series with
    the Stephens correction.  One small array job per row, so rows are features."""
    n, m = n.cast("double"), m.cast("double")
    en = n * m / (n + m)
    lam = (F.sqrt(en) + F.lit(0.12) + F.lit(0.11) / F.sqrt(en)) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda a, k: a + F.pow(F.lit(-1.0), (k - 1).cast("double"))
                         * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam))
    asymptotic = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0)))
    exact = F.greatest(n, m) <= params.ks_exact_max
    # Python columns are computed for all rows: those of large samples pass NULL
    return F.when(exact, _exact_p(F.when(exact, d), F.when(exact, n), F.when(exact, m))).otherwise(asymptotic)


def ks_two_sample(df: DataFrame, keys: list[str], sample: str = "sample", value: str = "value",
                  params: DriftParams = DEFAULT_DRIFT) -> DataFrame:
    """K1 on two raw samples per key (``sample`` is 'a' / 'b'):
    D = max over values |F_a - F_b| (right-continuous ECDFs), p, drifted.

    Distributed prefix sums over counts per distinct (key, value), see
    :func:`barsmith.operators.quantiles.running`.
    """
    keys = list(keys)
    d = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count_if(F.col(sample) == "a").alias("_ca"), F.count_if(F.col(sample) == "b").alias("_cb"))
    j = running(d, keys, value, ["_ca", "_cb"])
    gap = F.abs((F.col("_ca_before") + F.col("_ca")) / F.col("n_a") - (F.col("_cb_before") + F.col("_cb")) / F.col("n_b"))
    j = j.withColumnRenamed("_ca_all", "n_a").withColumnRenamed("_cb_all", "n_b")
    g = j.groupBy(*keys).agg(F.max(gap).alias("ks_statistic"), F.max("n_a").alias("n_a"),
                             F.max("n_b").alias("n_b"))
    small = F.col("n_b") < params.min_feature_samples
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_a"), F.col("n_b"), params)
    return g.select(*keys, F.when(small, F.lit(0.0)).otherwise(F.col("ks_statistic")).alias("ks_statistic"),
                    F.when(small, F.lit(1.0)).otherwise(p).alias("ks_p_value")) \
        .withColumn("ks_drifted", F.col("ks_p_value") < params.ks_alpha)
