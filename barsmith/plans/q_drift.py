"""Queries: profile / baseline (A1, A2, R4), drift (K1-K6), captures.

Inputs derived from ``events`` (FIXTURES part B): features ``value``,
``k`` (from ``props``) and ``hour``; baseline window ts < 2024-01-21,
live window ts >= 2024-01-24; capture lines built from the live events.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from barsmith.operators import drift as D
from barsmith.operators.profile import baseline_stats, to_long
from barsmith.params import DEFAULT_DRIFT as DP
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, rounded, sql_round
from barsmith.session import checkpoint_dir
from barsmith.sources import captures as C
from barsmith.sources.snapshots import fingerprint, publish, read_commit
from barsmith.sources.store import scratch_path

FEATS = C.EVENT_FEATURES
PSI_PROBS = [i / DP.psi_bins for i in range(DP.psi_bins + 1)]


# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------
def _event_base(spark, sf_dir):
    ev = C.event_features(spark, sf_dir)
    return ev.filter(F.col("ts") < F.lit(C.BASELINE_END).cast("timestamp_ntz"))


def _event_live(spark, sf_dir):
    ev = C.event_features(spark, sf_dir)
    return ev.filter(F.col("ts") >= F.lit(C.LIVE_START).cast("timestamp_ntz"))


def _baseline(spark, sf_dir):
    """The stored baseline (one row per feature), written once and read back
    like the reference's baseline document."""
    from barsmith.session import materialize
    return materialize(baseline_stats(_event_base(spark, sf_dir), FEATS), "baseline")


def stored_baseline(spark, sf_dir):
    """The published baseline of the window's present rows.  The commit is named
    by those rows, so it is fitted when they are new or changed and loaded
    otherwise, however many checks run."""
    root = os.path.join(checkpoint_dir(spark), "baseline-store")
    window = _event_base(spark, sf_dir).select("event_id", *FEATS)
    commit = "events-" + fingerprint(window)
    try:
        return read_commit(spark, root, commit)
    except LookupError:
        publish(baseline_stats(window, FEATS), root, commit)
        return read_commit(spark, root, commit)


def _live_long(spark, sf_dir):
    return to_long(_event_live(spark, sf_dir), FEATS)


def _round_arrays(df, cols, d):
    from barsmith.plans.registry import round_col
    return df.select(*[F.transform(c, lambda x: round_col(x, d)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------------------
# SQL fragments
# ---------------------------------------------------------------------------
EF = """
  SELECT event_id, ts, event_type, CAST(value AS DOUBLE) AS value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CAST(hour(ts) AS DOUBLE) AS hour
  FROM events"""


def _long(src: str, where: str, feats=None) -> str:
    return "\n  UNION ALL\n".join(
        f"  SELECT '{f}' AS feature, {f} AS v FROM {src} WHERE {where}" for f in (feats or FEATS))


BASE_WHERE = f"ts < TIMESTAMP '{C.BASELINE_END}'"
LIVE_WHERE = f"ts >= TIMESTAMP '{C.LIVE_START}'"
_D = "CAST({} AS DOUBLE)"


def _fl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def baseline_ctes(base_long: str | None = None, n_train: str | None = None) -> dict[str, str]:
    """Baseline profile CTEs; defaults: the events baseline window."""
    pct = ", ".join(f"quantile_cont(v, {_fl(p)}) AS {n}" for p, n in
                    {0.05: "p5", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.95: "p95"}.items())
    return {
        "ef": EF,
        "base_long": base_long or _long("ef", BASE_WHERE),
        "mom": f"""
  SELECT feature, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS mn, max(v) AS mx,
         count(*) AS n_samples, {pct}
  FROM base_long WHERE v IS NOT NULL GROUP BY feature""",
        "ed": """
  SELECT *, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS a,
            CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS b FROM mom""",
        "ed2": f"""
  SELECT *, list_concat(list_transform(range({DP.hist_bins}),
             lambda i: a + i * ((b - a) / CAST({DP.hist_bins} AS DOUBLE))), [b]) AS bin_edges
  FROM ed""",
        "hb": f"""
  SELECT l.feature, len(list_filter(e.bin_edges[1:{DP.hist_bins}], lambda x: x <= l.v)) - 1 AS bin
  FROM base_long l JOIN ed2 e ON l.feature = e.feature WHERE l.v IS NOT NULL""",
        "hc": "  SELECT feature, bin, count(*) AS c FROM hb GROUP BY feature, bin",
        "grid": f"  SELECT feature, unnest(range({DP.hist_bins})) AS bin FROM ed2",
        "dense": """
  SELECT g.feature, list(coalesce(h.c, 0) ORDER BY g.bin) AS counts
  FROM grid g LEFT JOIN hc h ON g.feature = h.feature AND g.bin = h.bin GROUP BY g.feature""",
        "bstats": f"""
  SELECT e.feature, e.mean, e.std, e.mn AS min, e.mx AS max, e.p5, e.p25, e.p50, e.p75, e.p95,
         e.n_samples, d.counts, e.bin_edges,
         ({n_train or f"SELECT count(*) FROM ef WHERE {BASE_WHERE}"}) AS n_train_samples, 'raw' AS space
  FROM ed2 e JOIN dense d ON e.feature = d.feature""",
    }


def drift_ctes(live_long: str | None = None, extra: dict[str, str] | None = None,
               keys=(), base: dict[str, str] | None = None) -> dict[str, str]:
    """KS / PSI by brute force over the expanded baseline samples; ``keys``
    are extra grouping columns of ``live_long`` (e.g. a window end);
    ``base``: CTEs to put first (the baseline's own sources)."""
    c = dict(base or {})
    c.update(baseline_ctes(*(() if base is None else (c.pop("_base_long"), c.pop("_n_train")))))
    c.update(extra or {})
    c["live_long"] = live_long or _long("ef", LIVE_WHERE)
    probs = "[" + ", ".join(_fl(p) for p in PSI_PROBS) + "]"
    k = "".join(f"{x}, " for x in keys)                 # "w, " or ""
    kq = lambda a: "".join(f"{a}.{x}, " for x in keys)
    kon = lambda a, b: "".join(f" AND {a}.{x} = {b}.{x}" for x in keys)
    part = f"PARTITION BY {k}feature"
    c.update({
        "pairs": f"""
  SELECT feature, (bin_edges[i] + bin_edges[i + 1]) / CAST(2 AS DOUBLE) AS m, counts[i] AS c
  FROM bstats, range(1, {DP.hist_bins + 1}) t(i)""",
        "samp": "  SELECT p.feature, p.m FROM pairs p JOIN range(0, 10000000) n(j) ON n.j < p.c",
        "lv": f"  SELECT {k}feature, v FROM live_long WHERE v IS NOT NULL AND feature IN (SELECT feature FROM bstats)",
        "kset": f"  SELECT DISTINCT {k}feature FROM lv",
        "pts": f"""
  SELECT {kq('q')}s.feature, s.m AS x, 1 AS ib, 0 AS il FROM samp s JOIN kset q ON s.feature = q.feature
  UNION ALL SELECT {k}feature, v, 0, 1 FROM lv""",
        "pagg": f"  SELECT {k}feature, x, sum(ib) AS cb, sum(il) AS cl FROM pts GROUP BY {k}feature, x",
        "cdf": f"""
  SELECT {k}feature,
         sum(cb) OVER w AS sb, sum(cl) OVER w AS sl,
         CAST(sum(cb) OVER ({part}) AS DOUBLE) AS nb,
         CAST(sum(cl) OVER ({part}) AS DOUBLE) AS nl
  FROM pagg WINDOW w AS ({part} ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "ks0": f"""
  SELECT {k}feature, max(abs(sb / nb - sl / nl)) AS d, any_value(nb) AS nb, any_value(nl) AS nl
  FROM cdf GROUP BY {k}feature""",
        "ks": f"  SELECT {k}feature, d, nb, nl FROM ks0 WHERE nl > 0",
        **Q.ks_p_ctes(["feature", *keys]),
        "edges": f"""
  SELECT feature, list_sort(list_distinct(quantile_cont(m, {probs}))) AS e FROM samp GROUP BY feature""",
        "bbin": """
  SELECT s.feature, len(list_filter(e.e[1:len(e.e) - 1], lambda q: q <= s.m)) - 1 AS bin
  FROM samp s JOIN edges e ON s.feature = e.feature
  WHERE len(e.e) >= 2 AND s.m >= e.e[1] AND s.m <= e.e[len(e.e)]""",
        "lbin": f"""
  SELECT {kq('s')}s.feature, len(list_filter(e.e[1:len(e.e) - 1], lambda q: q <= s.v)) - 1 AS bin
  FROM lv s JOIN edges e ON s.feature = e.feature
  WHERE len(e.e) >= 2 AND s.v >= e.e[1] AND s.v <= e.e[len(e.e)]""",
        "bgrid": f"""
  SELECT {kq('q')}q.feature, unnest(range(len(e.e) - 1)) AS bin
  FROM edges e JOIN kset q ON e.feature = q.feature WHERE len(e.e) >= 2""",
        "psi0": f"""
  SELECT {kq('g')}g.feature,
    sum((greatest(coalesce(lc.c, 0) / k.nl, {DP.psi_clip!r}) - greatest(coalesce(bc.c, 0) / k.nb, {DP.psi_clip!r}))
        * ln(greatest(coalesce(lc.c, 0) / k.nl, {DP.psi_clip!r}) / greatest(coalesce(bc.c, 0) / k.nb, {DP.psi_clip!r})))
      AS psi
  FROM bgrid g JOIN ks0 k ON g.feature = k.feature{kon('g', 'k')}
  LEFT JOIN (SELECT feature, bin, count(*) AS c FROM bbin GROUP BY ALL) bc ON g.feature = bc.feature AND g.bin = bc.bin
  LEFT JOIN (SELECT {k}feature, bin, count(*) AS c FROM lbin GROUP BY ALL) lc
    ON g.feature = lc.feature AND g.bin = lc.bin{kon('g', 'lc')}
  GROUP BY {kq('g')}g.feature""",
        "dfeat": f"""
  SELECT {kq('k')}k.feature,
    CASE WHEN k.nl < {DP.min_feature_samples} THEN 0.0 ELSE k.d END AS ks_statistic,
    CASE WHEN k.nl < {DP.min_feature_samples} THEN 1.0 ELSE k.p END AS ks_p_value,
    CASE WHEN k.nl < {DP.min_feature_samples} THEN 0.0 ELSE coalesce(p.psi, 0.0) END AS psi
  FROM ksp k LEFT JOIN psi0 p ON k.feature = p.feature{kon('k', 'p')}""",
        "drift": f"""
  SELECT {k}feature, ks_statistic, ks_p_value, ks_p_value < {DP.ks_alpha} AS ks_drifted, psi,
    CASE WHEN psi < {DP.psi_stable} THEN 'stable' WHEN psi < {DP.psi_investigate} THEN 'investigate'
         ELSE 'severe' END AS psi_severity
  FROM dfeat""",
    })
    return c


def report_rows_sql(keys, n_live_src: str) -> str:
    """Per-key report rows (A8) from the ``drift`` CTE; ``n_live_src`` is a
    relation (keys..., n_live_samples)."""
    k = "".join(f"d.{x}, " for x in keys)
    on = " AND ".join(f"d.{x} = n.{x}" for x in keys)
    return f"""
SELECT {k}n_features_drifted, drift_fraction, max_psi,
       drift_fraction >= {DP.drift_fraction_threshold} AS overall_drift_detected,
       (max_psi >= {DP.psi_investigate}) OR (drift_fraction >= {DP.drift_fraction_threshold}) AS trigger_retraining,
       n.n_live_samples, (SELECT any_value(n_train_samples) FROM bstats) AS n_baseline_samples
FROM (
  SELECT {"".join(f"{x}, " for x in keys)}count(*) FILTER (WHERE ks_drifted) AS n_features_drifted,
         count(*) FILTER (WHERE ks_drifted) / count(*) AS drift_fraction,
         coalesce(max(psi), 0.0) AS max_psi
  FROM drift GROUP BY {", ".join(keys)}) d JOIN {n_live_src} n ON {on}"""


def _report_select(n_live_sql: str, gate: str = "") -> str:
    return f"""
SELECT n_features_drifted, drift_fraction, max_psi,
       drift_fraction >= {DP.drift_fraction_threshold} AS overall_drift_detected,
       (max_psi >= {DP.psi_investigate}) OR (drift_fraction >= {DP.drift_fraction_threshold}) AS trigger_retraining,
       n_live_samples, n_baseline_samples
FROM (
  SELECT count(*) FILTER (WHERE ks_drifted) AS n_features_drifted,
         CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE ks_drifted) / count(*) ELSE 0.0 END AS drift_fraction,
         coalesce(max(psi), 0.0) AS max_psi,
         ({n_live_sql}) AS n_live_samples,
         (SELECT any_value(n_train_samples) FROM bstats) AS n_baseline_samples
  FROM drift) r {gate}"""


def _rsel(cols, src="drift"):
    return "SELECT " + ", ".join(c if c in ("feature", "ks_drifted", "psi_severity") else R(c, c)
                                 for c in cols) + f" FROM {src}"


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
_BS_COLS = ["feature", "mean", "std", "min", "max", "p5", "p25", "p50", "p75", "p95",
            "n_samples", "counts", "bin_edges", "n_train_samples", "space"]


def _bs_sql():
    sel = []
    for c in _BS_COLS:
        if c in ("mean", "std", "min", "max", "p5", "p25", "p50", "p75", "p95"):
            sel.append(R(c, c))
        elif c == "bin_edges":
            sel.append(f"list_transform(bin_edges, lambda x: {sql_round('x', 6)}) AS bin_edges")
        else:
            sel.append(c)
    return Q.cte(**baseline_ctes()) + "SELECT " + ", ".join(sel) + " FROM bstats"


@query("baseline_stats", _bs_sql)
def q_baseline_stats(spark, sf_dir):
    return _round_arrays(rounded(_baseline(spark, sf_dir)), ["bin_edges"], 6)


@query("baseline_histogram", lambda: Q.cte(**baseline_ctes()) +
       "SELECT feature, counts, list_transform(bin_edges, lambda x: " + sql_round("x", 6) +
       ") AS bin_edges FROM bstats")
def q_baseline_histogram(spark, sf_dir):
    b = _baseline(spark, sf_dir).select("feature", "counts", "bin_edges")
    return _round_arrays(b, ["bin_edges"], 6)


@query("baseline_midpoints", lambda: Q.cte(**baseline_ctes()) + """
SELECT feature, m AS mid, c AS weight FROM (
  SELECT feature, unnest(list_transform(range(1, 21), lambda i: """ +
       sql_round("(bin_edges[i] + bin_edges[i + 1]) / CAST(2 AS DOUBLE)", 6) + """)) AS m,
         unnest(counts) AS c FROM bstats)""")
def q_baseline_midpoints(spark, sf_dir):
    """(mid, weight) pairs instead of np.repeat re-expansion."""
    from barsmith.plans.registry import round_col
    m = D.baseline_midpoints(_baseline(spark, sf_dir))
    z = m.select("feature", F.explode(F.arrays_zip("mids", "counts")).alias("z"))
    return z.select("feature", round_col(F.col("z.mids"), 6).alias("mid"), F.col("z.counts").alias("weight"))


@query("drift_features", lambda: Q.cte(**drift_ctes()) +
       _rsel(["feature", "ks_statistic", "ks_p_value", "ks_drifted", "psi", "psi_severity"]))
def q_drift_features(spark, sf_dir):
    return rounded(D.drift_features(_baseline(spark, sf_dir), _live_long(spark, sf_dir)))


@query("ks_two_sample", lambda: Q.cte(**drift_ctes()) + _rsel(["feature", "ks_statistic", "ks_p_value", "ks_drifted"]))
def q_ks(spark, sf_dir):
    return rounded(D.drift_features(_baseline(spark, sf_dir), _live_long(spark, sf_dir))
                   .select("feature", "ks_statistic", "ks_p_value", "ks_drifted"))


@query("psi", lambda: Q.cte(**drift_ctes()) + _rsel(["feature", "psi"]))
def q_psi(spark, sf_dir):
    return rounded(D.drift_features(_baseline(spark, sf_dir), _live_long(spark, sf_dir))
                   .select("feature", "psi"))


@query("psi_severity", lambda: Q.cte(**drift_ctes()) + _rsel(["feature", "psi_severity"]))
def q_psi_severity(spark, sf_dir):
    return D.drift_features(_baseline(spark, sf_dir), _live_long(spark, sf_dir)) \
        .select("feature", "psi_severity")


@query("psi_ranked", lambda: Q.cte(**drift_ctes()) + """
SELECT feature, """ + R("psi", "psi") + """,
  CASE WHEN psi > 0.2 THEN 'red' WHEN psi > 0.1 THEN 'orange' ELSE 'green' END AS band,
  row_number() OVER (ORDER BY psi DESC, feature) AS psi_rank
FROM drift""")
def q_psi_ranked(spark, sf_dir):
    """Features by PSI, descending, with the chart's colour band
    (strict > 0.2 / > 0.1, unlike the severity's < bounds)."""
    from pyspark.sql import Window
    d = D.drift_features(_baseline(spark, sf_dir), _live_long(spark, sf_dir))
    band = F.when(F.col("psi") > 0.2, "red").when(F.col("psi") > 0.1, "orange").otherwise("green")
    # one row per feature: the ranking window is over a schema-sized table
    w = Window.orderBy(F.desc("psi"), "feature")
    return rounded(d.select("feature", "psi", band.alias("band"),
                            F.row_number().over(w).cast("long").alias("psi_rank")))


@query("drift_report", lambda: Q.cte(**drift_ctes()) +
       "SELECT " + ", ".join(
           R(c, c) if c in ("drift_fraction", "max_psi") else c for c in
           ["n_features_drifted", "drift_fraction", "max_psi", "overall_drift_detected",
            "trigger_retraining", "n_live_samples", "n_baseline_samples"]) +
       " FROM (" + _report_select(f"SELECT count(*) FROM ef WHERE {LIVE_WHERE}") + ")")
def q_drift_report(spark, sf_dir):
    base = _baseline(spark, sf_dir)
    live = _event_live(spark, sf_dir)
    feats = D.drift_features(base, to_long(live, FEATS))
    n_live = live.agg(F.count(F.lit(1)).alias("n_live_samples"))
    n_base = base.agg(F.max("n_train_samples").alias("n_baseline_samples"))
    return rounded(D.drift_report(feats, n_live, n_base))


# ---- captures ----------------------------------------------------------------
CAP = f"""
  SELECT event_id, ts, CASE WHEN event_id % {C.CORRUPT_MOD} = {C.BLANK_RES} THEN '' ELSE CAST(to_json({{
    'captureData': {{'endpointInput': {{
       'encoding': CASE WHEN event_id % 2 = 1 THEN 'BASE64' ELSE 'JSON' END,
       'data': CASE WHEN event_id % {C.CORRUPT_MOD} = {C.CORRUPT_RES} THEN 'corrupt'
                    WHEN event_id % 2 = 1 THEN to_base64(encode(body))
                    ELSE body END}}}}}}) AS VARCHAR) END AS line
  FROM (SELECT *, CAST(to_json({{'ticker': upper(event_type), 'features': [value, k, hour]}}) AS VARCHAR) AS body
        FROM ef WHERE {LIVE_WHERE})"""

PARSED = """
  SELECT event_id, ts, try(json_extract_string(b, '$.ticker')) AS ticker,
         try(CAST(json_extract(b, '$.features') AS DOUBLE[])) AS features
  FROM (SELECT event_id, ts,
          CASE WHEN coalesce(try(json_extract_string(trim(line), '$.captureData.endpointInput.encoding')),
                             'BASE64') = 'BASE64'
               THEN try(decode(from_base64(try(json_extract_string(trim(line), '$.captureData.endpointInput.data')))))
               ELSE try(json_extract_string(trim(line), '$.captureData.endpointInput.data')) END AS b
        FROM cap WHERE trim(line) <> '') t"""


def _capture_ctes():
    return {"ef": EF, "cap": CAP, "parsed0": PARSED,
            "parsed": "  SELECT * FROM parsed0 WHERE features IS NOT NULL AND len(features) > 0"}


def _vectors(spark, sf_dir):
    return C.parse_captures(C.capture_lines(spark, sf_dir))


@query("capture_parse", lambda: Q.cte(**_capture_ctes()) +
       "SELECT event_id, ticker, list_transform(features, lambda x: " + sql_round("x", 6) + ") AS features FROM parsed")
def q_capture_parse(spark, sf_dir):
    v = _vectors(spark, sf_dir).select("event_id", "ticker", "features")
    return _round_arrays(v, ["features"], 6)


@query("capture_recent", lambda: Q.cte(ef=EF) + f"""
SELECT event_id FROM ef
WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - INTERVAL 3 DAY""")
def q_capture_recent(spark, sf_dir):
    """Capture files in one folder a day (YYYY/MM/DD of their path), read
    as of 2024-01-30 with 3 days; the other folders are pruned."""
    lines = C.capture_lines(spark, sf_dir, start=None)
    root = scratch_path(spark, "captures")
    C.write_dated(lines, root)
    return C.read_recent(spark, root, lines.schema, "2024-01-30", 3).select("event_id")


@query("vector_to_long", lambda: Q.cte(**_capture_ctes()) + """
SELECT event_id, feature, """ + R("v", "value") + """ FROM (
  SELECT event_id, unnest(['value', 'k', 'hour']) AS feature, unnest(features) AS v
  FROM parsed WHERE len(features) = 3)""")
def q_vector_to_long(spark, sf_dir):
    return rounded(C.vector_to_long(_vectors(spark, sf_dir), "features", FEATS, ["event_id"]))


def _check_sql():
    live = """
  SELECT 'value' AS feature, features[1] AS v FROM parsed WHERE len(features) = 3
  UNION ALL SELECT 'k', features[2] FROM parsed WHERE len(features) = 3
  UNION ALL SELECT 'hour', features[3] FROM parsed WHERE len(features) = 3"""
    c = drift_ctes(live_long=live, extra={k: v for k, v in _capture_ctes().items() if k != "ef"})
    cols = ["n_features_drifted", "drift_fraction", "max_psi", "overall_drift_detected",
            "trigger_retraining", "n_live_samples", "n_baseline_samples"]
    sel = ", ".join(R(x, x) if x in ("drift_fraction", "max_psi") else x for x in cols)
    return Q.cte(**c) + f"SELECT {sel} FROM (" + _report_select(
        "SELECT count(*) FROM parsed", f"WHERE n_live_samples >= {DP.min_samples}") + ")"


def drift_check(spark, sf_dir, min_samples: int = DP.min_samples):
    """K5: captures -> vectors -> F9 gate -> long -> K3 -> K4 (one row, or
    none when fewer than ``min_samples`` vectors were captured), against the
    stored baseline."""
    from barsmith.session import materialize
    # parse the capture JSON once: the vector count and the drift counts
    # both read the parsed table
    vec = materialize(_vectors(spark, sf_dir), "vectors")
    base = stored_baseline(spark, sf_dir)
    feats = D.drift_features(base, C.vector_to_long(vec, "features", FEATS, ["event_id"]))
    n_live = vec.agg(F.count(F.lit(1)).alias("n_live_samples"))
    n_base = base.agg(F.max("n_train_samples").alias("n_baseline_samples"))
    rep = D.drift_report(feats, n_live, n_base)
    return rounded(rep.filter(F.col("n_live_samples") >= min_samples))


query("drift_check", _check_sql)(drift_check)


@query("drift_min_samples", lambda: _check_sql().replace(
    f"WHERE n_live_samples >= {DP.min_samples}", "WHERE n_live_samples >= 1000000000"))
def q_drift_min_samples(spark, sf_dir):
    """the same check with a gate above the captured count -> no report."""
    return drift_check(spark, sf_dir, min_samples=1_000_000_000)


@query("drift_small_sample", lambda: Q.cte(**drift_ctes(live_long=_long(
    "ef", LIVE_WHERE + " AND event_id % 1000 < 3"))) +
       _rsel(["feature", "ks_statistic", "ks_p_value", "ks_drifted", "psi", "psi_severity"]))
def q_drift_small_sample(spark, sf_dir):
    """a live window this small (< 10 values per feature) gives
    (D, p, drifted, PSI) = (0, 1, false, 0)."""
    live = _event_live(spark, sf_dir).filter(F.col("event_id") % 1000 < 3)
    return rounded(D.drift_features(_baseline(spark, sf_dir), to_long(live, FEATS)))


@query("drift_missing_feature", lambda: Q.cte(**drift_ctes(live_long=_long("ef", LIVE_WHERE, ["value", "k"]))) +
       _rsel(["feature", "ks_statistic", "ks_p_value", "ks_drifted", "psi", "psi_severity"]))
def q_drift_missing_feature(spark, sf_dir):
    """a baseline feature absent from the live data is skipped."""
    live = to_long(_event_live(spark, sf_dir), ["value", "k"])
    return rounded(D.drift_features(_baseline(spark, sf_dir), live))


@query("drift_banner", lambda: Q.cte(**drift_ctes()) + """
SELECT CASE WHEN overall_drift_detected THEN 'alert' WHEN max_psi > 0.1 THEN 'moderate'
            ELSE 'stable' END AS banner FROM (""" + _report_select(
    f"SELECT count(*) FROM ef WHERE {LIVE_WHERE}") + ")")
def q_drift_banner(spark, sf_dir):
    """Alert / moderate / stable."""
    rep = q_drift_report(spark, sf_dir)
    return rep.select(F.when(F.col("overall_drift_detected"), "alert")
                      .when(F.col("max_psi") > 0.1, "moderate").otherwise("stable").alias("banner"))


# ---- K1 on raw samples -------------------------------------------------------------
def _ks_raw_sql():
    both = "\n  UNION ALL\n".join(
        [f"  SELECT '{f}' AS feature, 'a' AS s, {f} AS v FROM ef WHERE {BASE_WHERE}" for f in FEATS] +
        [f"  SELECT '{f}' AS feature, 'b' AS s, {f} AS v FROM ef WHERE {LIVE_WHERE}" for f in FEATS])
    c = {"ef": EF, "ab": both,
         "agg": """
  SELECT feature, v, count(*) FILTER (WHERE s = 'a') AS ca, count(*) FILTER (WHERE s = 'b') AS cb
  FROM ab WHERE v IS NOT NULL GROUP BY feature, v""",
         "cdf": """
  SELECT feature, sum(ca) OVER w AS sa, sum(cb) OVER w AS sb,
         CAST(sum(ca) OVER (PARTITION BY feature) AS DOUBLE) AS na,
         CAST(sum(cb) OVER (PARTITION BY feature) AS DOUBLE) AS nb
  FROM agg WINDOW w AS (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
         "ks": "  SELECT feature, max(abs(sa / na - sb / nb)) AS d, any_value(na) AS nb, any_value(nb) AS nl FROM cdf GROUP BY feature",
         **Q.ks_p_ctes(["feature"])}
    return Q.cte(**c) + f"""
SELECT feature, {sql_round(f'CASE WHEN nl < {DP.min_feature_samples} THEN 0.0 ELSE d END', 6)} AS ks_statistic,
  {sql_round(f'CASE WHEN nl < {DP.min_feature_samples} THEN 1.0 ELSE p END', 6)} AS ks_p_value,
  CASE WHEN nl < {DP.min_feature_samples} THEN false ELSE p < {DP.ks_alpha} END AS ks_drifted
FROM ksp"""


@query("ks_raw", _ks_raw_sql)
def q_ks_raw(spark, sf_dir):
    """K1 (``run_ks_test``): raw baseline-window values vs raw live values."""
    base = to_long(_event_base(spark, sf_dir), FEATS).withColumn("sample", F.lit("a"))
    live = to_long(_event_live(spark, sf_dir), FEATS).withColumn("sample", F.lit("b"))
    return rounded(D.ks_two_sample(base.unionByName(live), ["feature"]))


# ---- the 30-feature panel: training-split baseline vs test-split rows ----------------
def _panel_ctes(live: bool = True) -> dict[str, str]:
    from barsmith.plans.q_splits import _g_ctes
    from barsmith.params import DEFAULT_FEATURES
    feats = DEFAULT_FEATURES.feature_names()
    base = _g_ctes()
    base["_base_long"] = "\n  UNION ALL\n".join(
        f"  SELECT '{f}' AS feature, {f} AS v FROM g3 WHERE split = 'train'" for f in feats)
    base["_n_train"] = "SELECT count(*) FROM g3 WHERE split = 'train'"
    live_sql = "\n  UNION ALL\n".join(
        f"  SELECT '{f}' AS feature, {f} AS v FROM g3 WHERE split = 'test'" for f in feats)
    return drift_ctes(live_long=live_sql, base=base) if live else \
        {**{k: v for k, v in base.items() if not k.startswith("_")},
         **baseline_ctes(base["_base_long"], base["_n_train"])}


def _panel_split(spark, sf_dir):
    from barsmith.operators import splits as SP
    from barsmith.plans.q_splits import _fm
    from barsmith.session import materialize
    return materialize(SP.three_way_split(_fm(spark, sf_dir)), "panel_split")


def _panel_baseline(spark, sf_dir, d):
    from barsmith.params import DEFAULT_FEATURES
    from barsmith.session import materialize
    train = d.filter(F.col("split") == "train")
    return materialize(baseline_stats(train, DEFAULT_FEATURES.feature_names()), "panel_baseline")


@query("baseline_stats_panel", lambda: Q.cte(**_panel_ctes(live=False)) + "SELECT " + ", ".join(
    R(c, c) if c in ("mean", "std", "min", "max", "p5", "p25", "p50", "p75", "p95") else
    (f"list_transform(bin_edges, lambda x: {sql_round('x', 6)}) AS bin_edges" if c == "bin_edges" else c)
    for c in _BS_COLS) + " FROM bstats")
def q_baseline_stats_panel(spark, sf_dir):
    """A1 + A2 on the 30 features of the training split (the stored baseline)."""
    d = _panel_split(spark, sf_dir)
    return _round_arrays(rounded(_panel_baseline(spark, sf_dir, d)), ["bin_edges"], 6)


@query("drift_panel", lambda: Q.cte(**_panel_ctes()) +
       _rsel(["feature", "ks_statistic", "ks_p_value", "ks_drifted", "psi", "psi_severity"]))
def q_drift_panel(spark, sf_dir):
    """K3 on the 30-feature panel: test-split rows against the training-split baseline."""
    from barsmith.params import DEFAULT_FEATURES
    d = _panel_split(spark, sf_dir)
    base = _panel_baseline(spark, sf_dir, d)
    live = to_long(d.filter(F.col("split") == "test"), DEFAULT_FEATURES.feature_names())
    return rounded(D.drift_features(base, live))
