"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c: Column, d: int) -> Column:
    """round(x * 10^d) / 10^d.

    Rounds the IEEE product half away from zero, which is what DuckDB and
    C ``round`` do, so exact decimal ties agree across engines.  (Python's
    ``round`` is half-even on the binary value; Spark's ``round`` is
    HALF_UP on the shortest decimal repr; neither is relied on at ties.)
    """
    scale = float(10 ** d)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)
