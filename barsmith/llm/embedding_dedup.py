"""Embedding near-dedup (operator 6): cross-polytope hashing, verified.

Vectors are scaled to length one and padded to a power of two d.  A hash turns
a vector by three rounds of random signs and a fast Hadamard transform and
takes the axis it lies closest to (2 d signed axes).  A table's key joins
``HASHES`` such axes with the label; besides the closest axes, the ``PROBES``
next likely combinations (the smallest loss in closeness) are keys too, so a
vector that lies between two axes is found under both.  ``TABLES`` tables make
the chance that a pair with cosine 0.98 shares no key small; tests measure the
recall against brute force.

Vectors that share a key are dealt out in tiles of at most ``TILE`` and each
pair of tiles is one unit of work: a matrix product in double precision
verifies its pairs.  A pair that shares several keys counts only under the
smallest, which both vectors' own keys tell, so links are counted without ever
being gathered; a unit gives each vector's number of links and a spanning
forest, never all pairs.  Equal vectors are one class, compared once and
counted with its size.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those without a label, link with nothing; vectors of different
lengths link with nothing; null ids take part and are ignored as smallest id;
repeated rows link with each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import session
from barsmith.llm.graph import components
from barsmith.session import materialize

TABLES, HASHES, PROBES = 10, 2, 3
TILE = 512
SEED = 61
THRESHOLD = 0.98


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row (a power of two long)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x


def signed_axes(unit: np.ndarray, seed: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` closest signed axes after one random rotation, and how much
    less close each is than the first."""
    d = unit.shape[1]
    rng, y = np.random.default_rng(seed), unit
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], d)) / np.sqrt(d)
    order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :top]
    value = np.take_along_axis(y, order, axis=1)
    near = np.abs(value)
    return 2 * order + (value < 0), near[:, :1] - near


def table_keys(unit: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """[n, tables * (1 + probes)] keys, without labels."""
    n, d = unit.shape
    wide = 1 << max(1, (d - 1).bit_length())
    unit = np.pad(unit, ((0, 0), (0, wide - d)))
    top = min(wide, probes + 1)
    # axis ranks of the hashes, (0, 0) first
    ranks = np.array(sorted(np.ndindex(*[top] * hashes), key=sum))
    out = []
    for t in range(tables):
        found = [signed_axes(unit, SEED + 1000 * t + k, top) for k in range(hashes)]
        loss = sum(found[k][1][:, ranks[:, k]] ** 2 for k in range(hashes))
        best = np.argsort(loss, axis=1, kind="stable")[:, :1 + probes]
        key = np.full(best.shape, t, dtype=np.int64)
        for k in range(hashes):
            key = key * (2 * wide) + np.take_along_axis(found[k][0], ranks[best, k], axis=1)
        out.append(key)
    return np.concatenate(out, axis=1)


def _vectors(lists) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, which are usable) of an Arrow list column whose usable
    entries have one length."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so squares neither vanish nor overflow
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _hashed(batches: Iterable) -> Iterator:
    import pyarrow as pa

    for b in batches:
        lists, n = b.column("v"), b.num_rows
        dims = np.diff(lists.offsets.to_numpy())
        for d in np.unique(dims).tolist():  # a key never joins different lengths: the length is in it
            at = np.flatnonzero(dims == d)
            part = b.take(pa.array(at))
            keys = table_keys(_unit(_vectors(part.column("v"))))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("cls"), part.column("label"), pa.array(np.full(len(at), d)), part.column("n"), part.column("v"), keys],
                                             names=["cls", "label", "dim", "n", "v", "keys"])
        if not n:
            continue


def unit_links(key: int, sides: np.ndarray, cls: np.ndarray, sizes: np.ndarray, unit: np.ndarray, keys: np.ndarray, threshold: float, across: bool) -> tuple[np.ndarray, list]:
    """Links that one unit of work counts (per vector, weighted by the other's
    class size) and a spanning forest of them.  ``sides``: 0 or 1, the tile a
    vector is from; with ``across`` only pairs from two tiles count."""
    cos = unit @ unit.T
    link = cos >= threshold
    np.fill_diagonal(link, False)
    if across:
        link &= sides[:, None] != sides[None, :]
    a, b = np.nonzero(np.triu(link))
    smaller = np.zeros(len(a), dtype=bool)
    block = max(1, 4_000_000 // keys.shape[1] ** 2)
    for s in range(0, len(a), block):
        x, y = keys[a[s:s + block]], keys[b[s:s + block]]
        same = (x[:, :, None] == y[:, None, :]) & (x[:, :, None] < key)
        smaller[s:s + block] = same.any(axis=(1, 2))
    own = ~smaller
    counts = np.bincount(a[own], weights=sizes[b[own]], minlength=len(cls)) + np.bincount(b[own], weights=sizes[a[own]], minlength=len(cls))
    parent = list(range(len(cls)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    # every link is in the forest of the unit that counts it
    for i, j in zip(a[own].tolist(), b[own].tolist(), strict=True):
        p, q = root(i), root(j)
        if p != q:
            parent[q] = p
            forest.append((cls[i], cls[j]))
    return counts.astype(np.int64), forest


def _verified(threshold: float):
    def verify(batches: Iterable) -> Iterator:
        import pyarrow as pa

        unit_id, rows = None, []

        def done():
            if len(rows) < 2:
                return [], [], []
            cls, side, n, v, keys = (list(x) for x in zip(*rows, strict=True))
            counts, forest = unit_links(unit_id[0], np.array(side), np.array(cls), np.array(n), np.stack(v), np.stack(keys), threshold, unit_id[3] != unit_id[4])
            some = np.flatnonzero(counts)
            return ([*(cls[i] for i in some), *(a for a, _ in forest)], [*[None] * len(some), *(b for _, b in forest)], [*counts[some].tolist(), *[0] * len(forest)])

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([x for f in found for x in f[0]], pa.int64()), pa.array([x for f in found for x in f[1]], pa.int64()),
                                               pa.array([x for f in found for x in f[2]], pa.int64())], names=["a", "b", "links"])

        for b in batches:
            found = []
            dims = b.column("dim").to_numpy()
            values, keys = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64), b.column("keys").flatten().to_numpy(zero_copy_only=False)
            ends, m = np.append(0, np.cumsum(dims)), len(keys) // max(1, b.num_rows)
            ids = zip(b.column("key").to_pylist(), b.column("label").to_pylist(), dims.tolist(), b.column("i").to_pylist(), b.column("j").to_pylist(), strict=True)
            for r, (row, cls, side, n) in enumerate(zip(ids, b.column("cls").to_pylist(), b.column("side").to_pylist(), b.column("n").to_pylist(), strict=True)):
                if row != unit_id:
                    found.append(done())
                    unit_id, rows = row, []
                v = values[ends[r]:ends[r + 1]][None]
                rows.append((cls, side, n, _unit(v)[0], keys[r * m:(r + 1) * m].copy()))
            if found:
                yield out(found)
        yield out([done()])

    return verify


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept; and class_id."""
    spark = session(vectors.sparkSession)
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable, F.col(label_col)).alias("label"),
                          F.when(usable, F.transform(v, lambda x: x + F.lit(0.0))).alias("v"))  # -0 is 0
    named = rows.withColumn("cls", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")))
    members = materialize(named.select("vec_id", "cls"), "vector-classes")
    classes = (named.filter("cls is not null").groupBy("cls").agg(F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"),
                                                               F.min("vec_id").alias("class_id")))
    classes = materialize(classes, "vectors")
    label_kind = classes.schema["label"].dataType.simpleString()
    hashed = classes.select("cls", "label", "n", "v").mapInArrow(_hashed, f"cls long, label {label_kind}, dim long, n long, v array<double>, keys array<long>")
    hashed = materialize(hashed, "hashed-vectors")
    keyed = hashed.select("cls", "label", "dim", F.explode("keys").alias("key"))
    sizes = materialize(keyed.groupBy("label", "dim", "key").agg(F.count("*").alias("m")).filter("m > 1"), "shared-keys")
    t = F.ceil(F.col("m") / TILE).cast("int")
    mine = (keyed.join(sizes, ["label", "dim", "key"]).withColumn("t", t)
            .withColumn("mine", F.pmod(F.xxhash64("cls", F.lit(5)), F.col("t")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
            .select("cls", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                    (F.col("mine") > F.col("other")).cast("int").alias("side")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = (mine.join(hashed, "cls").repartition(parts, "label", "dim", "key", "i", "j").sortWithinPartitions("label", "dim", "key", "i", "j")
            .select("key", "label", "dim", "i", "j", "side", "cls", "n", "v", "keys"))
    found = materialize(work.mapInArrow(_verified(threshold), "a long, b long, links long"), "vector-links")
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "cls")
    counts = found.filter("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    known = (classes.select("cls", "n", "class_id").join(counts, "cls", "left").join(roots, "cls", "left")
             .select("cls", "class_id", F.coalesce("root", "cls").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    known = materialize(known, "class-links")
    smallest = materialize(known.groupBy("root").agg(F.min("class_id").alias("component_id")), "vector-components")
    known = materialize(known.join(smallest, "root").select("cls", "class_id", "n_links", "component_id"), "class-components")
    linked = members.filter("cls is not null").join(known, "cls").select("vec_id", "n_links", "component_id", "class_id")
    alone = members.filter("cls is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").alias("class_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
