"""Published tables: snapshot commits on plain Parquet.

A commit writes its rows to a folder of its own and then one manifest row that
names the folder.  Readers take folders from the manifest only, so they see a
commit whole or not at all, and a job that dies between the two writes leaves
nothing visible.  Publishing a commit again is a no-op.  Layout under a root:

    data/commit=<id>/attempt=<unique>/...       rows
    manifest/commit=<id>/attempt=<unique>/...   one row

Two jobs that publish one commit at the same moment may both get through; the
manifest then holds two attempts, and every reader takes the smaller one (a
commit's name stands for its rows, so both hold the same).
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_PARTS = "commit string, attempt string"
_MANIFEST = "position string, n_rows long, schema string, " + _PARTS
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(commit, position, n_rows, schema, attempt), one row a published commit;
    no rows where nothing was published."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(os.path.join(root, "manifest"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "commit string, position string, n_rows long, schema string, attempt string")
    fields = ["position", "n_rows", "schema", "attempt"]
    one = rows.groupBy("commit").agg(F.min_by(F.struct(*fields), "attempt").alias("m"))
    return one.select("commit", *[F.col(f"m.{f}").alias(f) for f in fields])


def _newest(known: DataFrame):
    """The manifest row of the largest (position, commit), or None."""
    order = F.struct("position", "commit")
    return known.agg(F.max_by(F.struct(*known.columns), order).alias("m")).select("m.*").filter("commit IS NOT NULL").first()


def _schema(row) -> StructType:
    return StructType.fromJson(json.loads(row["schema"]))


def _folder(root: str, kind: str, commit: str, attempt: str) -> str:
    return os.path.join(root, kind, f"commit={commit}", f"attempt={attempt}")


def publish(df: DataFrame, root: str, commit: str, position: str | None = None,
            check: Callable[[], None] | None = None) -> bool:
    """Publishes the rows of ``df`` as ``commit``; False if that commit exists.

    ``position`` orders commits as text (the commit's name if None).  Columns
    must be those of the newest commit, names and types in order; a table
    without rows is a valid commit.  ``check`` runs once the rows are written;
    if it raises, the commit is not published."""
    if not _NAME.fullmatch(commit):
        raise ValueError(f"commit {commit!r} must be letters, digits, '.' and '-'")
    if clash := {"commit", "attempt"} & {c.lower() for c in df.columns}:
        raise ValueError(f"columns {sorted(clash)} are names of the layout")
    spark = df.sparkSession
    known = manifest(spark, root)
    if not known.filter(F.col("commit") == commit).isEmpty():
        return False
    last = _newest(known)
    if last is not None and _schema(last).simpleString() != df.schema.simpleString():
        raise ValueError(f"columns {df.schema.simpleString()} differ from the published {_schema(last).simpleString()}")
    attempt = uuid.uuid4().hex
    path = _folder(root, "data", commit, attempt)
    df.write.parquet(path)
    if check:
        check()
    n = spark.read.schema(df.schema).parquet(path).count()   # from the files' footers
    row = (position or commit, n, df.schema.json())
    (spark.createDataFrame([row], "position string, n_rows long, schema string")
          .coalesce(1).write.parquet(_folder(root, "manifest", commit, attempt)))
    return True


def read_commit(spark: SparkSession, root: str, commit: str | None = None) -> DataFrame:
    """The rows of one commit, the newest if None; LookupError if it is not published."""
    known = manifest(spark, root)
    row = _newest(known if commit is None else known.filter(F.col("commit") == commit))
    if row is None:
        raise LookupError(f"{commit or 'any commit'} is not published under {root}")
    return spark.read.schema(_schema(row)).parquet(_folder(root, "data", row["commit"], row["attempt"]))


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all commits with their ``commit``.  Folders that the manifest
    does not name are filtered by partition columns, not by their rows."""
    known = manifest(spark, root)
    last = _newest(known)
    if last is None:
        raise LookupError(f"nothing is published under {root}")
    schema = _schema(last).add("commit", StringType()).add("attempt", StringType())
    data = spark.read.schema(schema).parquet(os.path.join(root, "data"))
    return data.join(known.select("commit", "attempt"), ["commit", "attempt"], "left_semi").select(*_schema(last).names, "commit")


def fingerprint(df: DataFrame) -> str:
    """A name for the rows of ``df``, whatever their order: their number, and
    the XOR and the sum of their 64-bit hashes.  One mergeable aggregation."""
    h = F.xxhash64(*df.columns)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return f"{r['n']}-{(r['x'] or 0) % 2**64:016x}-{int(r['s'] or 0) % 2**64:016x}"


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON document a row (the text form of a snapshot)."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of :func:`write_documents`; a document that is no JSON is an error."""
    d = spark.read.text(path).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("d"))
    return d.select("d.*")
