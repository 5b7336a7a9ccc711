"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Outputs are rounded on both sides so that last-bit differences between
engines cannot flip a value hash: price-level columns to 4 decimals,
everything else to 6.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from barsmith.functions.numeric import round_half_away

Builder = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[Builder, str | None]] = {}

# Price-level columns (magnitudes in the thousands): 4 decimals.
_LEVEL = re.compile(
    r"^(open|high|low|close|volume|sma_\d+|ema_\d+|bb_upper|bb_lower|bb_mid|"
    r"volume_sma_\d+|obv|macd_line|macd_signal|macd_hist|rsi_\d+|.*_price|.*close.*|"
    r"mean|std|min|max|p\d+|center|scale|value|prediction|lower_bound|upper_bound|"
    r"avg_ms|p\d+_ms|max_value|latency_ms|sum_.*)$")


def decimals(col: str) -> int:
    return 4 if _LEVEL.match(col) else 6


def query(name: str, sql: str | Callable[[], str] | None = None):
    """Register a Spark builder and (optionally) its oracle SQL."""
    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise KeyError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


round_col = round_half_away


def rounded(df: DataFrame, skip=()) -> DataFrame:
    """Round every double column (see :func:`decimals`)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in skip:
            out.append(round_col(F.col(f.name), decimals(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def R(expr: str, col: str) -> str:
    """SQL twin of :func:`rounded` for one output column."""
    return f"{sql_round(expr, decimals(col))} AS {col}"


def sql_round(expr: str, d: int) -> str:
    return f"(ROUND(({expr}) * CAST({10 ** d} AS DOUBLE), 0) / CAST({10 ** d} AS DOUBLE))"


def all_queries() -> dict[str, Builder]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    out = {}
    for k, (_, sql) in _REGISTRY.items():
        if sql is None:
            continue
        out[k] = sql() if callable(sql) else sql
    return out


def _load() -> None:
    # importing the modules registers their queries
    from barsmith.plans import (  # noqa: F401
        q_features, q_bars, q_quality, q_splits, q_drift, q_backtest, q_ops,
        q_models, q_streams, q_published,
    )
