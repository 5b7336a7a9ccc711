"""Embedding whitening (operator 11): Spark MLlib ``BlockMatrix``.

Entries c become integers floor(256 * c).  The distinct integer vectors are the
fit list; they are numbered without gaps, centred with exact sums, and indexed
into a ``BlockMatrix`` of ``BLOCK_ROWS`` rows a block.  Its transpose times
itself is the scatter matrix; the contraction over rows is dealt over
``SPLIT_ROWS`` rows a task and partial products are added by key, so no task
sees all rows.  The driver holds only that d x d matrix (``numpy.linalg.eigh``),
and the sums.  All rows, numbered too, are projected by another ``BlockMatrix``
product with the d x k whitening matrix, and joined back by their unique number
(no hot key: equal vectors have different numbers).

Components whose eigenvalue is zero to double precision (at most d * eps times
the largest) cannot be whitened and are left out, so fewer than ``components``
may come back.  Covariances have the divisor n.

Defined results: rows whose vector is null, empty, holds null or non-finite
entries, or is shorter than the longest vector (entries missing) are dropped;
other nulls are kept; repeated rows stay repeated (and count once in the fit);
equal eigenvalues give some orthonormal basis; an empty table, and a fit list of
one vector, give no rows; other columns are ignored.  An overflow of 64 bits in
``deviation`` is an error under Spark's ANSI mode.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.session import materialize, prepare

BLOCK_ROWS, SPLIT_ROWS = 1024, 1 << 16
SCALE = 256.0


def usable(rows: DataFrame, vector_col: str) -> DataFrame:
    """Rows with a whole, finite vector, as ``x`` of 64-bit integers."""
    v = F.col(vector_col)
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = rows.filter(F.coalesce((F.size(v) > 0) & F.forall(v, finite), F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return rows.withColumn("x", x)


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written, with ``row`` = 0, 1, ... without gaps: a writing
    task's rows are numbered by it, tasks by the (small) table of their counts."""
    at = materialize(rows.withColumn("at", F.monotonically_increasing_id()), name)
    at = at.withColumn("task", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    # one row a task of the writing job
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    firsts = at.groupBy("task").agg((F.max("at") + 1).alias("n")).select("task", F.coalesce(before, F.lit(0)).alias("first"))
    return at.join(firsts, "task").withColumn("row", F.col("first") + F.col("at")).drop("task", "at", "first")


def blocks(rows: DataFrame, n: int, d: int, mean: Column) -> BlockMatrix:
    """Centred rows, indexed by ``row`` into distributed blocks."""
    centred = F.zip_with(F.col("x"), mean, lambda x, m: x.cast("double") - m)
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("row").alias("index"), array_to_vector(centred).alias("vector")), "vector")
    # kept for the products that read it; a lost block is made again from the written rows
    return IndexedRowMatrix(vectors, n, d).toBlockMatrix(BLOCK_ROWS, d).persist(StorageLevel.MEMORY_AND_DISK)


def gram(m: BlockMatrix) -> np.ndarray:
    """Transpose times itself, d x d.

    Python's ``multiply`` has no argument for the number of splits of the
    contracted dimension, without which a d x d product is one task; the JVM's
    public method has."""
    left, splits = m.transpose(), max(1, -(-int(m.numRows()) // SPLIT_ROWS))
    product = left._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def whiten(rows: DataFrame, *, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = prepare(rows.sparkSession)
    given = usable(rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")), "v").drop("v")
    kind = given.schema["vec_id"].dataType.simpleString()
    nothing = spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    given = numbered(given, "vectors")
    d, total = given.agg(F.max(F.size("x")), F.count("*")).first()
    if not total:
        return nothing
    whole = given.filter(F.size("x") == d)
    if whole.count() < total:  # rows of shorter vectors go, numbers close up
        whole = numbered(whole.drop("row"), "whole-vectors")
        total = whole.count()
    fit = numbered(whole.select("x").distinct(), "fit-list")
    n = fit.count()
    found = fit.select(F.posexplode("x").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("s")).collect()  # d rows
    s = [r["s"] for r in sorted(found, key=lambda r: r["k"])]
    array = lambda values, type_: F.array(*[F.lit(v) for v in values]).cast(f"array<{type_}>")
    mean = array([v / n for v in s], "double")
    m = blocks(fit, n, d, mean)
    cov = gram(m) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:components] > max(values[0], 0.0) * d * np.finfo(float).eps).sum())
    if not k:
        return nothing
    whitening = vectors[:, :k] / np.sqrt(values[:k])
    w = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, k, whitening.ravel("F")))], 1), d, k, d, k)
    error = float(np.abs(gram(m.multiply(w)) / n - np.eye(k)).max())
    explained = (values[:k] / np.trace(cov)).tolist()

    def rows_of(block):
        (i, _), values = block
        return [(i * BLOCK_ROWS + j, row) for j, row in enumerate(values.toArray().tolist())]

    projected = spark.createDataFrame(blocks(whole, total, d, mean).multiply(w).blocks.flatMap(rows_of), "row long, y array<double>")
    away = F.transform(F.zip_with("x", array(s, "long"), lambda x, t: x * F.lit(n).cast("long") - t), lambda z: z * z)
    out = whole.select("row", "vec_id", F.aggregate(away, F.lit(0).cast("long"), lambda a, z: a + z).alias("deviation"))
    share = array(explained, "double")
    return (out.join(projected, "row")
            .select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
