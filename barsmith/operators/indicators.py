"""Technical indicators (W1-W12) on the blocked series layout.

All indicators of one call share one window partitioning
(ticker, block) and one ordering (``_ord``), so the physical plan has a
single exchange + sort for the whole set.  Semantics follow pandas:
rolling windows need ``n`` non-null rows (``min_periods = n``), zero
denominators give NULL (``x.replace(0, nan)``), EWMs use adjust=False.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.params import FeatureParams, DEFAULT_FEATURES
from barsmith.operators import sequence as S

ALL = ("rsi", "sma", "ema", "macd", "bollinger", "volume", "obv", "vwap",
       "price", "lags", "target")


def _nz(c: Column) -> Column:
    """pandas ``replace(0, nan)``: zero becomes NULL."""
    return F.nullif(c, F.lit(0.0))


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, _nz(b))


def _pct(c: Column, prev: Column) -> Column:
    """pandas ``pct_change``: c / prev - 1 (NULL when prev is 0 / NULL)."""
    return F.try_divide(c, _nz(prev)) - F.lit(1.0)


def layout_needs(p: FeatureParams, include) -> tuple[int, int, list[float]]:
    """(back, fwd, alphas) the requested indicators need."""
    back, alphas = 1, []
    if "rsi" in include:
        alphas.append(1.0 / p.rsi_period)
    if "ema" in include:
        alphas += [2.0 / (s + 1) for s in p.ema_spans]
    if "macd" in include:
        alphas += [2.0 / (s + 1) for s in (p.macd_fast, p.macd_slow, p.macd_signal)]
    if include & {"sma", "bollinger", "volume", "vwap", "price", "lags"}:
        back = max(back, p.rolling_lookback())
    fwd = p.target_horizon if "target" in include else 0
    return back, fwd, alphas


def compute_indicators(bars: DataFrame, params: FeatureParams = DEFAULT_FEATURES,
                       include=ALL, *, by=("ticker",), order: str = "date",
                       period: str = "month", keep_ordinal: bool = False,
                       complete_cols=None, stage=None) -> DataFrame:
    """Bars -> bars + requested indicator columns (one row per input bar).

    ``complete_cols``: also add ``n_complete_`` = rows of the series where
    all these columns are non-null (from the same block table as OBV).
    ``stage``: optional ``DataFrame -> DataFrame`` applied to the windowed
    rows before the per-block totals are taken (e.g. write them once, so
    the totals do not recompute the windows in a second branch)."""
    p = params
    inc = set(include)
    by = list(by)
    back, fwd, alphas = layout_needs(p, inc)
    block = S.max_block_rows(alphas, 0, 0)

    d = S.with_ordinal(bars, by, order, period=period)
    d = S.blocked(d, by, block, back, fwd)

    c, o, h, l, v = (F.col(x) for x in ("close", "open", "high", "low", "volume"))
    lag = lambda x, k: F.lag(x, k).over(S.block_window(by))
    c1 = lag(c, 1)

    # ---- stage 1: lags, rolling aggregates ---------------------------------
    s1: list[Column] = []
    if "rsi" in inc or "obv" in inc:
        s1.append((c - c1).alias("_d1"))
    if "sma" in inc:
        s1 += [S.gated_rolling(F.avg, c, by, w).alias(f"sma_{w}") for w in p.sma_windows]
    if "bollinger" in inc:
        s1.append(S.gated_rolling(F.avg, c, by, p.bb_window).alias("_bb_mid"))
        s1.append(S.gated_rolling(F.stddev_samp, c, by, p.bb_window).alias("_bb_std"))
    if "volume" in inc:
        s1.append(S.gated_rolling(F.avg, v, by, p.volume_window)
                  .alias(f"volume_sma_{p.volume_window}"))
    if "vwap" in inc:
        tpv = (h + l + c) / F.lit(3.0) * v
        s1.append(S.gated_rolling(F.sum, tpv, by, p.volume_window).alias("_vw_num"))
        s1.append(S.gated_rolling(F.sum, v, by, p.volume_window).alias("_vw_den"))
    if "price" in inc:
        s1.append(_pct(c, c1).alias("returns_1d"))
        s1.append(_pct(c, lag(c, p.returns_long)).alias(f"returns_{p.returns_long}d"))
        s1.append(_div(h - l, c).alias("hl_range"))
        s1.append(_div(o - c1, c1).alias("gap"))
    if "lags" in inc:
        # lag_ret_p[t] = returns_1d[t-p] = c[t-p] / c[t-p-1] - 1
        s1 += [_pct(lag(c, k), lag(c, k + 1)).alias(f"lag_ret_{k}") for k in p.lag_periods]
    if "target" in inc:
        fwd_ret = _div(F.lead(c, p.target_horizon).over(S.block_window(by)) - c, c)
        if p.target_mode == "classification":
            # NaN > 0 is False in pandas: the tail becomes 0.0, not NULL
            s1.append(F.when(fwd_ret > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("target"))
        else:
            s1.append(fwd_ret.alias("target"))
    d = d.select("*", *s1)

    # ---- stage 2: row-local expressions -----------------------------------
    if "bollinger" in inc:
        mid, sd = F.col("_bb_mid"), F.col("_bb_std")
        up = mid + F.lit(p.bb_std) * sd
        lo = mid - F.lit(p.bb_std) * sd
        d = d.select("*", up.alias("bb_upper"), lo.alias("bb_lower"),
                     _div(up - lo, mid).alias("bb_width"),
                     _div(c - lo, up - lo).alias("bb_pct_b"))
    if "volume" in inc:
        d = d.withColumn("volume_ratio", _div(v, F.col(f"volume_sma_{p.volume_window}")))
    if "vwap" in inc:
        vwap = _div(F.col("_vw_num"), F.col("_vw_den"))
        d = d.withColumn("vwap_dev", _div(c - vwap, vwap))

    if "rsi" in inc:  # a NULL change stays NULL
        moved = F.col("_d1").isNotNull()
        d = d.select("*", F.when(moved, F.greatest(F.col("_d1"), F.lit(0.0))).alias("_gain"),
                     F.when(moved, F.greatest(-F.col("_d1"), F.lit(0.0))).alias("_loss"))
    d = d.filter(F.col(S.HOME))

    # ---- stage 3: exponential averages over the whole history --------------
    means = {}
    if "ema" in inc:
        means |= {f"ema_{s}": ("close", 2.0 / (s + 1)) for s in p.ema_spans}
    if "macd" in inc:
        means |= {"_fast": ("close", 2.0 / (p.macd_fast + 1)), "_slow": ("close", 2.0 / (p.macd_slow + 1))}
    if "rsi" in inc:
        means |= {"_ag": ("_gain", 1.0 / p.rsi_period), "_al": ("_loss", 1.0 / p.rsi_period)}
    if means:
        if stage is not None:
            d = stage(d)
        d = S.ewm_columns(d, by, means)
    if "rsi" in inc:
        rs = _div(F.col("_ag"), F.col("_al"))
        d = d.withColumn(f"rsi_{p.rsi_period}", F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs))
    if "macd" in inc:
        d = d.withColumn("macd_line", F.col("_fast") - F.col("_slow"))
        d = S.ewm_columns(d, by, {"macd_signal": ("macd_line", 2.0 / (p.macd_signal + 1))})
        d = d.withColumn("macd_hist", F.col("macd_line") - F.col("macd_signal"))

    sums, totals = {}, {}
    if "obv" in inc:
        # cumsum(sign(diff) * volume); first row 0 (sign NaN -> 0)
        d = d.withColumn("_obv_x", F.coalesce(F.signum(F.col("_d1")), F.lit(0.0)) * v)
        sums["_obv_x"] = "obv"
    if complete_cols:
        ok = F.lit(True)
        for name in complete_cols:
            if name != "obv":                   # never NULL
                ok = ok & F.col(name).isNotNull()
        d = d.withColumn("_complete_x", ok.cast("double"))
        totals["_complete_x"] = "n_complete_"
    if stage is not None:
        d = stage(d)
    if sums or totals:
        d = S.running_sums(d, sums, by, totals)

    drop = [x for x in d.columns if x.startswith("_") and not (keep_ordinal and x == S.ORD)]
    return d.drop(*drop)


def indicator_columns(params: FeatureParams, include) -> list[str]:
    """Output column names (in canonical order) for ``include``."""
    p, inc, out = params, set(include), []
    if "rsi" in inc:
        out.append(f"rsi_{p.rsi_period}")
    if "sma" in inc:
        out += [f"sma_{w}" for w in p.sma_windows]
    if "ema" in inc:
        out += [f"ema_{s}" for s in p.ema_spans]
    if "macd" in inc:
        out += ["macd_line", "macd_signal", "macd_hist"]
    if "bollinger" in inc:
        out += ["bb_upper", "bb_lower", "bb_width", "bb_pct_b"]
    if "volume" in inc:
        out += [f"volume_sma_{p.volume_window}", "volume_ratio"]
    if "obv" in inc:
        out.append("obv")
    if "vwap" in inc:
        out.append("vwap_dev")
    if "price" in inc:
        out += ["returns_1d", f"returns_{p.returns_long}d", "hl_range", "gap"]
    if "lags" in inc:
        out += [f"lag_ret_{k}" for k in p.lag_periods]
    if "target" in inc:
        out.append("target")
    return out
