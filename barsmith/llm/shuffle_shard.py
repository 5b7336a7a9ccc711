"""Sharding (operator 7): a reproducible global shuffle with computable slots.

Rows get global numbers 0..N-1 in an order that depends on their contents
only.  A Feistel network permutes the smallest even-width binary domain that
holds N; numbers that fall outside 0..N-1 are permuted again until they land
inside (cycle walking), so the result is a permutation of 0..N-1.  Position p
lies in shard ``p % shards`` at slot ``p // shards``: shard sizes differ by at
most one, slots have no gaps, and both follow from the row number alone
(:func:`place`), as the row number follows from them (:func:`row_at`).

Defined results: a null text has size 1 and crc 0 like an empty one; null
ids are numbered like any other value (nulls first); repeated rows each get
their own slot; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from barsmith.llm.common import session, text_of, with_copies
from barsmith.session import materialize

ROUNDS = 6
SEED = 20260807
# Buckets that the rows are numbered in; the table of their totals (one row
# each) is all that is ordered globally or broadcast.
BUCKETS = 4096


def _round_keys(seed: int) -> list[np.uint64]:
    rng = np.random.default_rng(seed)
    return [np.uint64(x) for x in rng.integers(1, 2**63 - 1, ROUNDS)]


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _network(x: np.ndarray, half: int, keys: list[np.uint64]) -> np.ndarray:
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = x >> shift, x & mask
    for k in keys:
        left, right = right, left ^ (_mix(right, k) & mask)
    # halves leave in swapped order: the same network with reversed keys undoes it
    return (right << shift) | left


def permute(x: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (or its inverse) applied to every entry."""
    keys, half = _round_keys(seed), _half_bits(n)
    if inverse:
        keys = keys[::-1]
    with np.errstate(over="ignore"):
        out = _network(np.asarray(x, dtype=np.uint64), half, keys)
        outside = np.flatnonzero(out >= np.uint64(n))
        while len(outside):
            out[outside] = _network(out[outside], half, keys)
            outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def place(row: int, n: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of a global row number."""
    p = int(permute(np.array([row]), n, seed)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = SEED) -> int:
    """The global row number at a shard's slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def numbered(df: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """``df`` with ``row``: 0..N-1 in an order given by the columns' values.

    Equal rows are counted first (combined before the shuffle) and expanded
    last, so a row repeated very often is no hot key.  The counted table is
    written once; the per-bucket totals and the numbering both read it."""
    spark, cols = df.sparkSession, df.columns
    counted = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    counted = materialize(counted.withColumn("_b", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")), "numbered")
    totals = counted.groupBy("_b").agg(F.sum("_n").alias("_t"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = materialize(totals.withColumn("_base", F.coalesce(F.sum("_t").over(before), F.lit(0))), "bucket-totals")
    n = totals.agg(F.sum("_t")).first()[0] or 0
    inside = Window.partitionBy("_b").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    rows = (counted.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
            .join(F.broadcast(totals.select("_b", "_base")), "_b"))  # at most `buckets` rows
    rows = with_copies(rows, "_n").withColumn("row", F.col("_base") + F.col("_before") + F.col("_copy"))
    return rows.select(*cols, "row"), n


def shard(docs: DataFrame, shards: int = 16, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, row (global number), shard, slot; law `rows`."""
    session(docs.sparkSession)
    facts = docs.select(F.col(id_col).alias("doc_id"),
                        (F.octet_length(text_of(text_col)).cast("long") + 1).alias("size"),
                        F.crc32(text_of(text_col)).alias("text_crc32"))
    rows, n = numbered(facts)

    @pandas_udf("long")
    def position(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    return (rows.withColumn("_p", position("row"))
            .withColumn("shard", F.pmod("_p", F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("_p") / shards).cast("long"))
            .drop("_p"))
