"""DuckDB oracle SQL fragments (independent re-statements of each query).

Each fragment is a CTE body over the driver's pre-registered views; the
oracle strings in :mod:`barsmith.plans.oracle` compose them.  Recursive
EWMs use a recursive CTE (row by row), not the engine's blocked scan.
"""

from __future__ import annotations

from barsmith.params import DEFAULT_DRIFT as DP
from barsmith.params import DEFAULT_FEATURES as P


def cte(**parts: str) -> str:
    """``WITH a AS (...), b AS (...)`` (adds RECURSIVE when needed)."""
    body = ",\n".join(f"{k} AS (\n{v}\n)" for k, v in parts.items())
    rec = "RECURSIVE " if any("UNION ALL" in v and f"FROM {k}" in v for k, v in parts.items()) else ""
    return f"WITH {rec}{body}\n"


BARS_D = """
  SELECT p.p_brand AS ticker, CAST(l.l_shipdate AS DATE) AS date,
         arg_min(l.l_extendedprice / NULLIF(l.l_quantity, 0),
                 (l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                  l.l_extendedprice, l.l_quantity)) AS open,
         max(l.l_extendedprice / NULLIF(l.l_quantity, 0)) AS high,
         min(l.l_extendedprice / NULLIF(l.l_quantity, 0)) AS low,
         arg_max(l.l_extendedprice / NULLIF(l.l_quantity, 0),
                 (l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                  l.l_extendedprice, l.l_quantity)) AS close,
         sum(l.l_quantity) AS volume
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2"""

BARS_H = """
  SELECT event_type AS ticker, date_trunc('hour', ts) AS date,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, (ts, event_id)) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2"""


def numbered(src: str) -> str:
    return f"""
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn,
         lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prev_close
  FROM {src}"""


def _alpha(span: int) -> str:
    return f"(CAST(2 AS DOUBLE) / {span + 1})"


def ewm_recursive(src: str = "bn") -> str:
    """EMA 12/26, MACD signal and Wilder RSI averages, one row at a time."""
    a12, a26, a9 = _alpha(P.macd_fast), _alpha(P.macd_slow), _alpha(P.macd_signal)
    ar = f"(CAST(1 AS DOUBLE) / {P.rsi_period})"
    return f"""
  SELECT ticker, rn, close, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS sig,
         CAST(NULL AS DOUBLE) AS ag, CAST(NULL AS DOUBLE) AS al
  FROM {src} WHERE rn = 1
  UNION ALL
  SELECT b.ticker, b.rn, b.close,
         {a12} * b.close + (1 - {a12}) * r.e12,
         {a26} * b.close + (1 - {a26}) * r.e26,
         {a9} * (({a12} * b.close + (1 - {a12}) * r.e12) - ({a26} * b.close + (1 - {a26}) * r.e26))
           + (1 - {a9}) * r.sig,
         CASE WHEN r.ag IS NULL THEN greatest(b.close - r.close, 0)
              ELSE {ar} * greatest(b.close - r.close, 0) + (1 - {ar}) * r.ag END,
         CASE WHEN r.al IS NULL THEN greatest(r.close - b.close, 0)
              ELSE {ar} * greatest(r.close - b.close, 0) + (1 - {ar}) * r.al END
  FROM ewm r JOIN {src} b ON b.ticker = r.ticker AND b.rn = r.rn + 1"""


def ewm_recursive_nulls(src: str = "bn") -> str:
    """The same means where closes may be NULL, one row at a time: the old
    weight (w*) decays over NULL rows and the next value renormalises."""
    means = {"e12": ("x.close", _alpha(P.macd_fast)), "e26": ("x.close", _alpha(P.macd_slow)),
             "ag": ("greatest(x.d, 0)", f"(CAST(1 AS DOUBLE) / {P.rsi_period})"), "al": ("greatest(-x.d, 0)", f"(CAST(1 AS DOUBLE) / {P.rsi_period})")}

    def mean(m, x, a):
        x = f"CASE WHEN {'x.close' if m[0] == 'e' else 'x.d'} IS NOT NULL THEN {x} END"
        return (f"CASE WHEN r.{m} IS NULL THEN {x} WHEN ({x}) IS NULL THEN r.{m} "
                f"ELSE (r.w{m} * (1 - {a}) * r.{m} + {a} * ({x})) / (r.w{m} * (1 - {a}) + {a}) END AS {m}, "
                f"CASE WHEN r.{m} IS NULL OR ({x}) IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE r.w{m} * (1 - {a}) END AS w{m}")

    one = "CAST(1 AS DOUBLE)"
    step = ", ".join(mean(m, x, a) for m, (x, a) in means.items())
    a9 = _alpha(P.macd_signal)
    return f"""
  SELECT ticker, rn, close AS e12, {one} AS we12, close AS e26, {one} AS we26,
         CAST(NULL AS DOUBLE) AS ag, {one} AS wag, CAST(NULL AS DOUBLE) AS al, {one} AS wal, close - close AS sig
  FROM {src} WHERE rn = 1
  UNION ALL
  SELECT ticker, rn, e12, we12, e26, we26, ag, wag, al, wal,
         CASE WHEN sig0 IS NULL THEN e12 - e26 ELSE {a9} * (e12 - e26) + (1 - {a9}) * sig0 END AS sig
  FROM (SELECT x.ticker, x.rn, {step}, r.sig AS sig0
        FROM ewm r JOIN (SELECT *, close - prev_close AS d FROM {src}) x ON x.ticker = r.ticker AND x.rn = r.rn + 1)"""


def _roll(expr: str, n: int, agg: str = "avg") -> str:
    w = f"OVER (PARTITION BY b.ticker ORDER BY b.date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({expr}) {w} = {n} THEN {agg}({expr}) {w} END"


def _lag(expr: str, k: int) -> str:
    return f"lag({expr}, {k}) OVER (PARTITION BY b.ticker ORDER BY b.date)"


def _pct(a: str, b: str) -> str:
    return f"({a} / NULLIF({b}, 0) - 1)"


def indicators_sql(src: str = "bn", ewm: str = "ewm") -> str:
    """All 30 features + target on numbered bars joined to the EWM rows."""
    c1 = _lag("b.close", 1)
    lags = ",\n".join(
        f"    {_pct(_lag('b.close', k), _lag('b.close', k + 1))} AS lag_ret_{k}" for k in P.lag_periods)
    smas = ",\n".join(f"    {_roll('b.close', w)} AS sma_{w}" for w in P.sma_windows)
    return f"""
  SELECT b.ticker, b.date, b.rn, b.close, b.open, b.high, b.low, b.volume,
    100 - 100 / (1 + e.ag / NULLIF(e.al, 0)) AS rsi_14,
{smas},
    e.e12 AS ema_12, e.e26 AS ema_26,
    e.e12 - e.e26 AS macd_line, e.sig AS macd_signal, (e.e12 - e.e26) - e.sig AS macd_hist,
    {_roll('b.close', P.bb_window)} AS bb_mid,
    {_roll('b.close', P.bb_window, 'stddev_samp')} AS bb_std,
    {_roll('b.volume', P.volume_window)} AS volume_sma_20,
    sum(coalesce(sign(b.close - b.prev_close), 0) * b.volume)
      OVER (PARTITION BY b.ticker ORDER BY b.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obv,
    {_roll('((b.high + b.low + b.close) / 3) * b.volume', P.volume_window, 'sum')} AS vw_num,
    {_roll('b.volume', P.volume_window, 'sum')} AS vw_den,
    {_pct('b.close', c1)} AS returns_1d,
    {_pct('b.close', _lag('b.close', P.returns_long))} AS returns_5d,
    (b.high - b.low) / NULLIF(b.close, 0) AS hl_range,
    (b.open - {c1}) / NULLIF({c1}, 0) AS gap,
{lags},
    (lead(b.close, {P.target_horizon}) OVER (PARTITION BY b.ticker ORDER BY b.date) - b.close)
      / NULLIF(b.close, 0) AS target
  FROM {src} b JOIN {ewm} e ON b.ticker = e.ticker AND b.rn = e.rn"""


FEATURES_DERIVED = """
  SELECT *,
    bb_mid + 2 * bb_std AS bb_upper, bb_mid - 2 * bb_std AS bb_lower,
    ((bb_mid + 2 * bb_std) - (bb_mid - 2 * bb_std)) / NULLIF(bb_mid, 0) AS bb_width,
    (close - (bb_mid - 2 * bb_std)) / NULLIF((bb_mid + 2 * bb_std) - (bb_mid - 2 * bb_std), 0) AS bb_pct_b,
    volume / NULLIF(volume_sma_20, 0) AS volume_ratio,
    (close - vw_num / NULLIF(vw_den, 0)) / NULLIF(vw_num / NULLIF(vw_den, 0), 0) AS vwap_dev
  FROM ind"""


def feature_ctes(bars: str = BARS_D) -> dict[str, str]:
    """CTE chain ending in ``fm`` (complete rows, >= min_rows per ticker)."""
    feats = ", ".join(P.feature_names())
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in [*P.feature_names(), "target"])
    return {
        "bars": bars,
        "bn": numbered("bars"),
        "ewm": ewm_recursive("bn"),
        "ind": indicators_sql("bn", "ewm"),
        "feat": FEATURES_DERIVED,
        "fm0": f"  SELECT ticker, date, close, {feats}, target FROM feat WHERE {notnull}",
        "fm": f"""
  SELECT * FROM fm0 WHERE ticker IN
    (SELECT ticker FROM fm0 GROUP BY ticker HAVING count(*) >= {P.min_rows})""",
    }


def bday_sql(d: str, n: int) -> str:
    """DuckDB twin of :func:`barsmith.functions.dates.bday_add` (isodow Mon=1)."""
    if n == 1:
        return f"({d} + CASE isodow({d}) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END)"
    return f"({d} - CASE isodow({d}) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END)"


def ks_p_ctes(keys: list[str]) -> dict[str, str]:
    """CTEs from ``ks`` (keys..., d, nb, nl) to ``ksp`` with p, the chance of a
    statistic of at least d.

    Small samples: lattice paths that stay inside the band |i n - j m| < h are
    counted row by row as the window sum of the row before, scaled so that the
    last row is a share of all paths; p is one minus that share.  A p whose
    bound is below 1e-12 counts as 0.  Larger samples: the asymptotic series."""
    on = " AND ".join(f"k.{c} = x.{c}" for c in keys)
    hi = "least(x.n, CAST(ceil(({i} * x.n + x.h) / x.m) AS BIGINT) - 1)"
    en = "(nb * nl / (nb + nl))"
    return {
        "kx": f"""
  SELECT *, exp(-(lgamma(n + m + 1) - lgamma(n + 1) - lgamma(m + 1)) / m) AS s FROM (
    SELECT {", ".join(keys)}, row_number() OVER (ORDER BY {", ".join(keys)}) AS kid,
           CAST(greatest(nb, nl) AS BIGINT) AS n, CAST(least(nb, nl) AS BIGINT) AS m, CAST(round(d * nb * nl) AS BIGINT) AS h
    FROM ks WHERE least(nb, nl) > 0 AND greatest(nb, nl) <= {DP.ks_exact_max} AND 4 * exp(-2 * d * d * {en}) > 1e-12)
  WHERE h > 0""",
        "paths": f"""
  SELECT x.kid, CAST(0 AS BIGINT) AS i, j, CAST(1 AS DOUBLE) AS a
  FROM (SELECT *, unnest(range(0, n + 1)) AS j FROM kx) x WHERE j * x.m < x.h
  UNION ALL
  SELECT kid, i, j, s * sum(a) OVER (PARTITION BY kid ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (SELECT kid, n, m, h, s, i + 1 AS i, unnest(js) AS j, unnest(list_concat([a], list_transform(js[2:], lambda q: CAST(0 AS DOUBLE)))) AS a
        FROM (SELECT x.*, p.i, p.a, CASE WHEN p.j = {hi.format(i="p.i")} THEN range(p.j, {hi.format(i="(p.i + 1)")} + 1) ELSE [p.j] END AS js
              FROM paths p JOIN kx x ON p.kid = x.kid WHERE p.i < x.m))
  WHERE abs(i * n - j * m) < h""",
        "inside": "  SELECT p.kid, sum(p.a) AS a FROM paths p JOIN kx x ON p.kid = x.kid WHERE p.i = x.m AND p.j = x.n GROUP BY p.kid",
        "ksp": f"""
  SELECT k.*, CASE
      WHEN round(k.d * k.nb * k.nl) = 0 THEN CAST(1 AS DOUBLE)
      WHEN greatest(k.nb, k.nl) <= {DP.ks_exact_max} THEN CASE WHEN x.kid IS NULL THEN CAST(0 AS DOUBLE)
        ELSE least(greatest(1 - coalesce(y.a, 0), 0), 1) END
      WHEN k.lam < 0.2 THEN CAST(1 AS DOUBLE) ELSE least(greatest(2 * list_sum(
            list_transform(range(1, 101), lambda q: pow(CAST(-1 AS DOUBLE), q - 1)
                           * exp(CAST(-2 AS DOUBLE) * q * q * k.lam * k.lam))), 0), 1) END AS p
  FROM (SELECT *, (sqrt({en}) + 0.12 + 0.11 / sqrt({en})) * d AS lam FROM ks) k
  LEFT JOIN kx x ON {on} LEFT JOIN inside y ON x.kid = y.kid"""}
