"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bday_add(d: Column, n: int = 1) -> Column:
    """Shift a date by one business day (Mon-Fri, no holidays), like
    ``date + BDay(n)`` for n = +1 / -1.

    +1: Fri -> Mon (+3), Sat -> Mon (+2), else +1.
    -1: Mon -> Fri (-3), Sun -> Fri (-2), else -1.
    Spark ``weekday``: Monday = 0.
    """
    wd = F.weekday(d)
    if n == 1:
        step = F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1)
    elif n == -1:
        step = -F.when(wd == 0, 3).when(wd == 6, 2).otherwise(1)
    else:
        raise ValueError("only +1 / -1 business-day shifts are supported")
    return F.date_add(d, step)


def version_tag(ts: Column) -> Column:
    """``yyyyMMdd-HHmmss`` version suffix of a timestamp."""
    return F.date_format(ts, "yyyyMMdd-HHmmss")


def parse_model_version(v: Column, prefix: str = "stock-model-") -> Column:
    """timestamp inside ``<prefix>YYYYMMDD-HHMMSS``; unparsable ->
    2000-01-01 (the reference's fallback)."""
    ts = F.try_to_timestamp(F.regexp_replace(v, "^" + prefix, ""), F.lit("yyyyMMdd-HHmmss"))
    return F.coalesce(ts, F.lit("2000-01-01 00:00:00").cast("timestamp"))


def epoch_ms_minute(ms: Column) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd HH:mm UTC``."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm 'UTC'")
