"""Feature matrix (W13) with projection / complete-case / min-rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.params import FeatureParams, DEFAULT_FEATURES
from barsmith.operators.indicators import ALL, compute_indicators


def feature_projection(df: DataFrame, params: FeatureParams = DEFAULT_FEATURES,
                       keys=("ticker", "date")) -> DataFrame:
    """keys + the ordered feature columns (everything but ``target``).

    The column list is explicit and checked against the input schema.
    """
    feats = params.feature_names()
    miss = [c for c in feats if c not in df.columns]
    if miss:
        raise ValueError(f"feature columns missing from input: {miss}")
    return df.select(*[k for k in keys if k in df.columns], *feats)


def complete_cases(df: DataFrame, subset=None) -> DataFrame:
    """drop rows with any NULL (warm-up head and horizon tail)."""
    return df.dropna(how="any", subset=subset)


def feature_matrix(bars: DataFrame, params: FeatureParams = DEFAULT_FEATURES, *,
                   order: str = "date", period: str = "month", keep=(),
                   write_once: bool = False) -> DataFrame:
    """Bars -> ``ticker, date, <features>, target``; complete rows only,
    series with at least ``params.min_rows`` rows.  ``keep``: extra bar
    columns to carry (e.g. ``close`` for the backtest).

    The complete-row count per series comes from the same per-block table
    as the OBV carry (one small aggregation + one join serve both), so F3
    needs no second pass over the features.  ``write_once``: the windowed
    rows are written to the shared checkpoint folder and the per-block
    totals read that table, instead of a second branch recomputing (and
    re-shuffling) every window."""
    feats = [*params.feature_names(), "target"]
    stage = None
    if write_once:
        from barsmith.session import materialize
        stage = lambda d: materialize(d, "windowed")
    ind = compute_indicators(bars, params, ALL, order=order, period=period, complete_cols=feats,
                             stage=stage)
    cols = ["ticker", order, *keep, *feats]
    fm = complete_cases(ind, subset=feats)
    if params.min_rows_mode == "fail":
        short = fm.filter(F.col("n_complete_") < params.min_rows).select("ticker", "n_complete_") \
            .limit(1).collect()
        if short:
            raise ValueError(f"{short[0][0]}: only {int(short[0][1])} rows after dropna, "
                             f"need >= {params.min_rows}")
        return fm.select(*cols)
    return fm.filter(F.col("n_complete_") >= params.min_rows).select(*cols)
