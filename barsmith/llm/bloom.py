"""Blocked Bloom filter as a table: one 512-bit block a row.

A key sets one bit in each of the eight words of its block.  The number of
blocks is fixed by the caller, not by the number of keys, so the table that is
broadcast never has more than ``blocks`` rows of 72 bytes; with very many keys
more rows pass, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BLOCKS = 1 << 14
_NAMES = ["__bloom", *(f"__bits{i}" for i in range(WORDS))]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit("mask"))
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def build(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of all values of ``key``; at most ``blocks`` rows."""
    masked = keys.select(_block(F.col(key), blocks).alias(_NAMES[0]), *[m.alias(n) for m, n in zip(_masks(F.col(key)), _NAMES[1:], strict=True)])
    return masked.groupBy(_NAMES[0]).agg(*[F.bit_or(n).alias(n) for n in _NAMES[1:]])


def _all_set(key: str) -> Column:
    test = F.lit(True)
    for m, n in zip(_masks(F.col(key)), _NAMES[1:], strict=True):
        test = test & (F.col(n).bitwiseAND(m) == m)
    return test


def possible_hits(df: DataFrame, key: str, filt: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows whose ``key`` may be in the filter (all that are, and a few more)."""
    joined = df.withColumn(_NAMES[0], _block(F.col(key), blocks)).join(F.broadcast(filt), _NAMES[0])
    return joined.filter(_all_set(key)).drop(*_NAMES)


def sure_misses(df: DataFrame, key: str, filt: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The other rows."""
    joined = df.withColumn(_NAMES[0], _block(F.col(key), blocks)).join(F.broadcast(filt), _NAMES[0], "left")
    return joined.filter(~F.coalesce(_all_set(key), F.lit(False))).drop(*_NAMES)
