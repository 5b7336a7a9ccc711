"""OHLCV data-quality rules (Q1-Q3, A3-A5, U4) and request validation.

All per-series rule counts come from ONE ``groupBy(ticker)`` with
mergeable aggregates (``count_if``, null counts, distinct-date counts), so
validation is a single shuffle of a tiny partial-aggregate state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from barsmith.sources import snapshots as SN
from barsmith.sources.bars import missing_columns

# Required bar columns, the ticker pattern, batch bounds.
REQUIRED = ["open", "high", "low", "close", "volume"]
TICKER_RE = r"\A[A-Z]{1,5}\z"
BATCH_MIN, BATCH_MAX = 1, 500
N_FEATURES = 30


def _pct1(x: Column) -> Column:
    """Python ``f"{x:.1%}"``."""
    return F.concat(F.format_string("%.1f", x * F.lit(100.0)), F.lit("%"))


def _row_rules() -> list[Column]:
    """Mergeable counts of one-row rules: NULLs by column, prices, High < Low, volume."""
    price_bad = (F.col("open") <= 0) | (F.col("high") <= 0) | (F.col("low") <= 0) | (F.col("close") <= 0)
    return [F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED],
            F.count_if(F.coalesce(price_bad, F.lit(False))).alias("n_nonpositive_price"),
            F.count_if(F.coalesce(F.col("high") < F.col("low"), F.lit(False))).alias("n_high_lt_low"),
            F.count_if(F.coalesce(F.col("volume") < 0, F.lit(False))).alias("n_negative_volume")]


OBSERVED = ["n_rows", *[f"null_{c}" for c in REQUIRED], "n_nonpositive_price", "n_high_lt_low", "n_negative_volume"]


def schema_errors(bars: DataFrame, order: str = "date") -> list[str]:
    """Rules that need no row: required columns, and ``order`` a date or time."""
    errors = [f"missing column {c}" for c in missing_columns(bars, [*REQUIRED, order])]
    if order in bars.columns and not isinstance(bars.schema[order].dataType, (DateType, TimestampType, TimestampNTZType)):
        errors.append(f"{order} is {bars.schema[order].dataType.simpleString()}, not a date or time")
    return errors


def observed_errors(counts: dict, max_null_pct: float = 0.05) -> list[str]:
    """What the observed counts of :func:`publish_checked` break."""
    n = counts["n_rows"]
    nulls = [f"{c}: {counts[f'null_{c}']} of {n} values are NULL" for c in REQUIRED if counts[f"null_{c}"] > max_null_pct * n]
    return nulls + [f"{k}: {counts[k]} rows" for k in OBSERVED[-3:] if counts[k]]


def publish_checked(bars: DataFrame, root: str, commit: str, *, order: str = "date",
                    max_null_pct: float = 0.05) -> tuple[dict | None, list[str]]:
    """Q1 / Q2 in the pass that writes: the row rules are counted by an
    observation on the write itself, and rows that break them are never
    published (see :mod:`barsmith.sources.snapshots`).

    Returns the observed counts over the whole table and the errors; published
    if there are none.  Counts are None for a schema error, where nothing is
    written, and for a commit that exists.  Rules on one series (its rows, its
    duplicate dates, its own NULL share) need a grouping: :func:`validate_ohlcv`.
    An empty table breaks no rule.  The observation sits in the stage that
    writes, whose tasks count once however often they are tried."""
    errors = schema_errors(bars, order)
    if errors:
        return None, errors
    seen = Observation("row-rules")
    counts = {}

    def check():
        counts.update(dict.fromkeys(OBSERVED, 0) | seen.get)     # an empty plan observes nothing
        errors.extend(observed_errors(counts, max_null_pct))
        if errors:
            raise _Refused

    try:
        SN.publish(bars.observe(seen, *_row_rules()), root, commit, check=check)
    except _Refused:
        pass
    return counts or None, errors


class _Refused(Exception):
    pass


def rule_counts(bars: DataFrame, by: str = "ticker", order: str = "date") -> DataFrame:
    """A3-A5: rows, per-column null counts, non-positive price rows,
    High < Low rows, negative volume rows, duplicate timestamps."""
    return bars.groupBy(by).agg(
        *_row_rules(),
        (F.count(F.lit(1)) - F.count_distinct(order)).alias("n_duplicate_dates"),
    )


def null_fractions(counts: DataFrame, by: str = "ticker") -> DataFrame:
    """A3: null fraction per column and the max over columns."""
    fr = [(F.col(f"null_{c}") / F.col("n_rows")).alias(f"null_frac_{c}") for c in REQUIRED]
    out = counts.select(by, *fr)
    return out.withColumn("max_null_frac", F.greatest(*[F.col(f"null_frac_{c}") for c in REQUIRED]))


def validate_ohlcv(bars: DataFrame, *, by: str = "ticker", order: str = "date",
                   max_null_pct: float = 0.05, min_rows: int = 100) -> DataFrame:
    """Q1: one row per ticker: ``valid``, ``errors`` array, ``warnings`` array.

    A missing required column short-circuits (schema-level, no job).
    """
    miss = missing_columns(bars, REQUIRED)
    if miss:
        return bars.select(by).distinct().select(
            by, F.lit(False).alias("valid"),
            F.array(F.concat(F.col(by), F.lit(f": missing required columns: {miss}"))).alias("errors"),
            F.array().cast("array<string>").alias("warnings"))
    c = rule_counts(bars, by, order)
    t = F.col(by)
    errs = [F.when(F.col("n_rows") < min_rows, F.concat(
        t, F.lit(": only "), F.col("n_rows").cast("string"), F.lit(f" rows, need at least {min_rows}")))]
    warns = []
    for col in REQUIRED:
        frac = F.col(f"null_{col}") / F.col("n_rows")
        errs.append(F.when(frac > max_null_pct, F.concat(
            t, F.lit(f".{col}: null fraction "), _pct1(frac), F.lit(f" > {max_null_pct:.0%}"))))
        warns.append(F.when((frac <= max_null_pct) & (frac > 0), F.concat(
            t, F.lit(f".{col}: "), _pct1(frac), F.lit(" nulls present"))))
    errs.append(F.when(F.col("n_nonpositive_price") > 0, F.concat(
        t, F.lit(": "), F.col("n_nonpositive_price").cast("string"), F.lit(" rows with non-positive prices"))))
    errs.append(F.when(F.col("n_high_lt_low") > 0, F.concat(
        t, F.lit(": "), F.col("n_high_lt_low").cast("string"), F.lit(" rows where High < Low"))))
    warns.append(F.when(F.col("n_duplicate_dates") > 0, F.concat(
        t, F.lit(": "), F.col("n_duplicate_dates").cast("string"), F.lit(" duplicate timestamps in index"))))
    errs.append(F.when(F.col("n_negative_volume") > 0, F.concat(
        t, F.lit(": "), F.col("n_negative_volume").cast("string"), F.lit(" rows with negative volume"))))
    e = F.array_compact(F.array(*errs))
    w = F.array_compact(F.array(*warns))
    return c.select(by, (F.size(e) == 0).alias("valid"), e.alias("errors"), w.alias("warnings"))


def assert_valid(bars: DataFrame, **kw) -> None:
    """Q2: raise on the first invalid series (an action on the tiny result)."""
    bad = validate_ohlcv(bars, **kw).filter(~F.col("valid")).limit(1).collect()
    if bad:
        r = bad[0]
        raise ValueError(f"OHLCV validation failed for {r[0]}:\n" + "\n".join(r["errors"]))


def normalize_ticker(raw: Column) -> Column:
    """Strip (any white space) + upper."""
    white = r"[\s\x1c-\x1f\x85\p{Z}]+"
    return F.upper(F.regexp_replace(raw, rf"\A{white}|{white}\z", ""))


def ticker_is_valid(raw: Column) -> Column:
    return F.coalesce(normalize_ticker(raw).rlike(TICKER_RE), F.lit(False))


def batch_is_valid(n_records: Column) -> Column:
    """R2: 1..500 vectors per request."""
    return n_records.between(BATCH_MIN, BATCH_MAX)
