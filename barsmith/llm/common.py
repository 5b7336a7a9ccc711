"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.session import prepare

# A word is a maximal run of characters other than space, \t, \n, \v, \f, \r.
SPACE = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# What one Arrow batch handed to Python holds at most; with whole texts in a
# batch this bounds a worker's memory (`slices` cuts batches further).
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def session(spark: SparkSession) -> SparkSession:
    """Settings the Arrow operators rely on; idempotent."""
    prepare(spark)
    for k, v in ARROW.items():
        spark.conf.set(k, v)
    return spark


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def words(c: Column) -> Column:
    """Array of the words of ``c`` (null: empty array)."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")


def slices(batches: Iterable, column: str, max_bytes: int) -> Iterator:
    """Arrow batches cut into runs of rows whose ``column`` holds at most
    ``max_bytes`` (a single longer value comes alone)."""
    import numpy as np

    for b in batches:
        col = b.column(column)
        n = len(col)
        if not n:
            continue
        import pyarrow.compute as pc

        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0)), dtype=np.int64)
        i = 0
        while i < n:
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield b.slice(i, j - i)
            i = j


def tokenizer_path(name: str) -> str:
    """Default place of a public vocabulary file on this host (every executor
    has the package installed; operators take the path as a parameter)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def with_copies(df: DataFrame, n: str, *, direct: int = 65536) -> DataFrame:
    """Every row as often as its column ``n`` says, with ``_copy`` = 0..n-1.

    Rows that stand for more than ``direct`` copies are first cut into blocks
    of ``direct`` that are dealt to different tasks, so that one row that
    stands for a third of the table is not expanded by one task."""
    few = df.filter(F.col(n) <= direct).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    many = (df.filter(F.col(n) > direct)
            .withColumn("_blk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / direct))))
            .repartition(F.col("_blk"), F.col(n))
            .withColumn("_copy", F.explode(F.sequence(F.col("_blk") * direct,
                                                      F.least((F.col("_blk") + 1) * direct, F.col(n)) - 1)))
            .drop("_blk"))
    return few.unionByName(many)
