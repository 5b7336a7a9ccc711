"""N-gram Jaccard join (operator 5): all links, exactly, as components.

A document's set holds the hashes of its distinct five-word shingles.  Links
(Jaccard >= 0.8) are found in three steps.

1. Buckets.  Sets are put in size bands that double; two sets that link share
   the band of the larger one, where the smaller one takes part too if 1.25
   times its size reaches it.  In a band of upper size N the hash space is cut
   into m equal ranges, about 0.27 N.  Two linked sets differ in at most
   d = floor((|A| + |B|) / 9) elements, so if more than d ranges of one of them
   hold two or more of its elements, at least one such range holds the same
   elements in both: the band, the range and its elements are the bucket key.
   Of a set's n keys of a band the d + 1 smallest do: at most d are lacking in
   the other set, so the smallest shared key is among these in both.
   A set with too few such ranges also takes part under each of its smallest
   n - ceil(0.8 n) + 1 hashes, of which two linked sets share at least one; so
   no link is lost.  A line or passage that many documents share hardly ever
   fills a range alone, which keeps buckets of unlike sets small.
2. Tiles.  Buckets with the same members are reduced to one.  A bucket is dealt
   out in tiles of at most ``TILE`` sets, and each pair of tiles is one unit
   of work, so no task gathers a whole bucket.  Units see the sets' sizes and
   hashed bitmaps (about four bits an element) only: each differing bit is at
   least one differing element, so bit counts bound the overlap from above and
   tell which sets of a unit may link.
   The keys are never written by row: they go into the shuffle that finds the
   shared ones, along with one row for each document.
3. Verification.  A unit's possible links are walked breadth-first, and only
   the steps of the walk, a spanning forest, are verified by exact
   intersection of the sorted arrays, each pair once however many units give
   it.  That leaves the units in which a step of the walk joins sets that are
   not connected by verified links (a possible link between unconnected sets
   has such a step on its way): for their sets, all pairs that are not yet
   connected are compared exactly, bit counts first.  Neither step ever gives
   all pairs of a group; :mod:`graph` joins the links.

Sets are 64-bit hashes; documents with the same set (128-bit digest) are one
class and are compared once.

Defined results: null and word-less texts have 0 shingles and are their own
component; fewer than five words are one shingle; null ids take part and are
ignored as smallest id; equal ids with different texts are judged by text;
repeated rows stay repeated; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm import bloom
from barsmith.llm.common import ascii_lower, session, text_of, words
from barsmith.llm.graph import components
from barsmith.session import bucketed, materialize

WIDTH = 5  # words a shingle
TILE = 512  # sets a tile
SHARE, EXTRA = 0.27, 2  # ranges of a band: SHARE * N + EXTRA
KEY_BITS = np.uint64((1 << 48) - 1)  # of a bucket key; two that meet by chance cost a comparison only
SEEN = 1_000_000  # digests a task remembers to give a class's keys once


def shingles(c: Column) -> Column:
    """Sorted array of the hashes of the distinct shingles."""
    return F.sort_array(F.array_distinct(shingles_of_words(words(ascii_lower(c)))))


def shingles_of_words(w: Column) -> Column:
    def of(x):  # x: the words, made once a row
        n = F.size(x)
        each = F.transform(F.sequence(F.lit(1), n - (WIDTH - 1)), lambda i: F.xxhash64(*[F.get(x, i + k) for k in range(-1, WIDTH - 1)]))
        return F.when(n == 0, F.array().cast("array<long>")).when(n < WIDTH, F.array(F.xxhash64(x))).otherwise(each)

    return F.element_at(F.transform(F.array(w), of), 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def ranges_of_band(band: np.ndarray) -> np.ndarray:
    return np.ceil(SHARE * 2.0**band).astype(np.int64) + EXTRA


def band_of(size: np.ndarray) -> np.ndarray:
    """The band with 2**(band-1) < size <= 2**band."""
    return np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)


def bucket_keys(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Bucket keys of each set; ``flat`` holds the sets' sorted (as signed)
    hashes one after the other."""
    n_sets = len(sizes)
    out: list[list[np.ndarray]] = [[] for _ in range(n_sets)]
    if not n_sets:
        return []
    with np.errstate(over="ignore"):
        h = flat.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)  # same order, unsigned
        mixed, owner = _mix(h), np.repeat(np.arange(n_sets), sizes)
        own = band_of(sizes)
        up = band_of(sizes + sizes // 4)
        lacking = np.zeros(n_sets, dtype=bool)
        for which, band in (("own", own), ("up", up)):
            part = (sizes > 3) & (np.ones(n_sets, dtype=bool) if which == "own" else up != own)
            sel = part[owner]
            if not sel.any():
                continue
            o, m = owner[sel], ranges_of_band(band).astype(np.uint64)
            r = ((h[sel] >> np.uint64(32)) * m[o]) >> np.uint64(32)
            starts = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (r[1:] != r[:-1])))
            counts = np.diff(np.append(starts, len(o)))
            sums = np.add.reduceat(mixed[sel], starts)
            full = counts >= 2
            so = o[starts][full]
            label = band[so].astype(np.uint64) << np.uint64(48) | r[starts][full] + np.uint64(1)
            keys = _mix(sums[full] ^ _mix(label)) & KEY_BITS
            # differing elements that a link through this band can have at most
            largest = np.minimum(sizes + sizes // 4, 1 << band) if which == "own" else sizes + sizes // 4
            differ = (sizes + largest) // 9
            lacking |= part & (np.bincount(so, minlength=n_sets) <= differ)
            for i, k in zip(*_split(so, keys), strict=True):
                out[i].append(np.sort(k)[:differ[i] + 1])
        first = np.cumsum(sizes) - sizes
        for i in np.flatnonzero(lacking):
            n = int(sizes[i])
            prefix = h[first[i]:first[i] + n - -(-4 * n // 5) + 1]
            out[i].append(_mix(_mix(prefix) + np.uint64(1)) & KEY_BITS)
    return [np.concatenate(x).view(np.int64) if x else np.empty(0, dtype=np.int64) for x in out]


def _split(owner: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(owner):
        return [], []
    at = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    return owner[np.append(0, at)].tolist(), np.split(values, at)


def bitmap(values: np.ndarray) -> np.ndarray:
    """Hashed bitmap of a set: its low hash bits, in bytes (a power of two)."""
    bits = 1 << max(8, min(20, (4 * len(values)).bit_length()))
    out = np.zeros(bits, dtype=bool)
    out[values.view(np.uint64) & np.uint64(bits - 1)] = True
    return np.packbits(out, bitorder="little")


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps brought to the shortest one's length, as rows of 64-bit words:
    folding keeps the rule that a differing bit is a differing element."""
    width = min(len(m) for m in maps)
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, width), axis=0) for m in maps]).view(np.uint64)


def possible(a: int, rest: np.ndarray, sizes: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """Those of ``rest`` that sizes and bit counts allow to link with ``a``."""
    total = sizes[rest] + sizes[a]
    near = 9 * np.minimum(sizes[rest], sizes[a]) >= 4 * total
    rest, total = rest[near], total[near]
    differ = np.bitwise_count(maps[rest] ^ maps[a]).sum(axis=1, dtype=np.int64)
    return rest[9 * ((total - differ) // 2) >= 4 * total]  # the most they can share


def walk(n: int, linked) -> list[tuple[int, int]]:
    """A spanning forest of n items, breadth-first; ``linked(a, rest)`` gives
    those of the items ``rest``, not yet reached, that a links with."""
    open_, edges = np.ones(n, dtype=bool), []
    for seed in range(n):
        if not open_[seed]:
            continue
        open_[seed], queue = False, [seed]
        while queue:
            a = queue.pop()
            for b in linked(a, np.flatnonzero(open_)).tolist():
                open_[b] = False
                edges.append((a, b))
                queue.append(b)
    return edges


def likely_forest(sizes: np.ndarray, maps: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links that sizes and bit counts allow."""
    return walk(len(sizes), lambda a, rest: possible(a, rest, sizes, maps))


def undecided(sizes: np.ndarray, maps: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Which sets may link with one of another root."""
    out = np.zeros(len(sizes), dtype=bool)
    if len(set(roots.tolist())) > 1:
        for a in range(len(sizes) - 1):
            rest = a + 1 + np.flatnonzero(roots[a + 1:] != roots[a])
            found = possible(a, rest, sizes, maps)
            if len(found):
                out[a] = out[found] = True
    return out


def shared_enough(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the sorted arrays have a Jaccard of 0.8 or more with ``a``."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    at = np.searchsorted(a, flat)
    hit = a[np.minimum(at, len(a) - 1)] == flat
    shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return 9 * shared >= 4 * (sizes + len(a))


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` (sorted hash arrays)."""
    sizes = np.array([len(s) for s in sets])
    maps = folded([bitmap(s) for s in sets])

    def linked(a, rest):
        rest = possible(a, rest, sizes, maps)
        return rest[shared_enough(sets[a], [sets[i] for i in rest])] if len(rest) else rest

    return walk(len(sets), linked)


def _keyed(batches: Iterable) -> Iterator:
    """(id, row digest, set) -> (id, row digest, size, class digest, bucket keys)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    seen: set[int] = set()
    for b in batches:
        lists = b.column("set")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        keys = bucket_keys(flat, sizes)
        if len(seen) > SEEN:
            seen.clear()
        for i, c in enumerate(b.column("c1").to_pylist()):
            if c in seen:
                keys[i] = keys[i][:0]
            seen.add(c)
        offsets = np.append(0, np.cumsum([len(k) for k in keys])).astype(np.int32)
        values = np.concatenate([*keys, np.empty(0, dtype=np.int64)])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("r1"), b.column("r2"), pa.array(sizes), b.column("c1"), b.column("c2"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
            names=["doc_id", "r1", "r2", "n_shingles", "c1", "c2", "keys"])


def _units(batches: Iterable, columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[list]]]:
    """((key, i, j), rows) of each unit, from Arrow rows sorted by unit;
    a unit holds two tiles at most."""
    unit, rows = None, []
    for b in batches:
        values = [list(b.column(c)) if c in ("set", "bits") else b.column(c).to_pylist() for c in columns]
        keys = zip(b.column("key").to_pylist(), b.column("i").to_pylist(), b.column("j").to_pylist(), strict=True)
        for row, *value in zip(keys, *values, strict=True):
            if row != unit:
                if rows:
                    yield unit, rows
                unit, rows = row, []
            rows.append(value)
    if rows:
        yield unit, rows


def _bitmaps(batches: Iterable) -> Iterator:
    import pyarrow as pa

    for b in batches:
        sets = [x.values.to_numpy(zero_copy_only=False) for x in b.column("set")]
        yield pa.RecordBatch.from_arrays([b.column("c1"), pa.array([len(x) for x in sets], pa.int64()), pa.array([bitmap(x).tobytes() for x in sets], pa.binary())],
                                         names=["c1", "size", "bits"])


def _batched(rows: Iterable[tuple], names: list[str], size: int = 10_000) -> Iterator:
    import pyarrow as pa

    held = []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)] or [pa.array([], pa.int64())] * len(names), names=names)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield out()
            held = []
    yield out()


def _maps(members: list[list]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([m[1] for m in members]), folded([np.frombuffer(m[2].as_py(), dtype=np.uint8) for m in members])


def _likely(batches: Iterable) -> Iterator:
    """Likely links of each unit's classes, from rows with their bitmaps."""
    def rows():
        for unit, members in _units(batches, ("c1", "size", "bits")):
            if len(members) > 1:
                for a, b in likely_forest(*_maps(members)):
                    yield (*unit, *sorted((members[a][0], members[b][0])))

    return _batched(rows(), ["key", "i", "j", "a", "b"])


def _undecided(batches: Iterable) -> Iterator:
    """Rows of the sets of each unit that may link with one of another root."""
    def rows():
        for unit, members in _units(batches, ("c1", "size", "bits", "root")):
            if len(members) > 1:
                for k in np.flatnonzero(undecided(*_maps(members), np.array([m[3] for m in members]))).tolist():
                    yield (*unit, members[k][0])

    return _batched(rows(), ["key", "i", "j", "c1"])


def _linked(batches: Iterable) -> Iterator:
    """Links of classes, from rows with their sets."""
    def rows():
        for _, members in _units(batches, ("c1", "set")):
            sets = [m[1].values.to_numpy(zero_copy_only=False) for m in members]
            for a, b in forest(sets):
                yield members[a][0], members[b][0]

    return _batched(rows(), ["a", "b"])


def _with_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    sets = docs.select(F.col(id_col).alias("doc_id"), *_row_keys(id_col, text_col), shingles(text_of(text_col)).alias("set"))
    return sets.select("doc_id", "r1", "r2", "set", F.xxhash64("set").alias("c1"), F.xxhash64("set", F.lit(1)).alias("c2"))


def _row_keys(id_col: str, text_col: str) -> list[Column]:
    """Digest of a row's id and text, never null."""
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("r1"), F.xxhash64(F.col(text_col), F.lit(2), F.col(id_col)).alias("r2")]


def _id_key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def shared_buckets(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c1, doc_id, r1, r2, n_shingles, c2) of every row of ``sets``, and (key,
    c1) of the bucket keys that classes share.  Both come out of one shuffle: a
    document's row is dealt by its place, the first of the rows with its keys."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    keyed = sets.mapInArrow(_keyed, f"doc_id {kind}, r1 long, r2 long, n_shingles long, c1 long, c2 long, keys array<long>")
    rows = keyed.select("*", F.explode(F.concat(F.array(F.lit(None).cast("long")), "keys")).alias("key"))
    place = F.monotonically_increasing_id().alias("place")
    doc = F.when(F.col("key").isNull(), F.struct("doc_id", "r1", "r2", "n_shingles", "c2", place))
    rows = rows.select("c1", doc.alias("doc"), "key").select("c1", F.coalesce("key", F.xxhash64("doc.place")).alias("key"), "doc")
    w, c1 = Window.partitionBy("key"), F.when(F.col("doc").isNull(), F.col("c1"))
    rows = (rows.select("*", F.min(c1).over(w).alias("_lo"), F.max(c1).over(w).alias("_hi"))
            .filter("doc is not null or _lo < _hi").select("key", "c1", "doc").distinct())
    rows = materialize(rows, "shared-buckets")
    named = rows.filter("doc is not null").select("c1", *[F.col(f"doc.{c}").alias(c) for c in ("doc_id", "r1", "r2", "n_shingles", "c2")])
    return named, rows.filter("doc is null").select("key", "c1")


def linked_classes(docs: DataFrame, keyed: DataFrame, shared: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, root): digests of classes that have links, and their components."""
    spark = docs.sparkSession
    # buckets with the same members are one
    members = shared.groupBy("key").agg(F.count("*").alias("n"), *[
        F.sum(F.xxhash64("c1", F.lit(s)).cast("decimal(38,0)")).alias(f"s{s}") for s in (0, 1)])
    kept = materialize(members.groupBy("n", "s0", "s1").agg(F.min("key").alias("key")).select("key", "n"), "kept-buckets")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    mine = (shared.join(kept, "key").withColumn("t", tiles)
            .withColumn("mine", F.pmod(F.xxhash64("c1", F.lit(7)), F.col("t")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
            .select("key", "c1", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))
    mine = materialize(mine, "tile-members")
    # the sets of the classes that share a bucket, from one text each: a
    # Bloom filter of those texts' ids spares the others the shingling
    needed = mine.select("c1").distinct()
    texts = keyed.groupBy("c1").agg(F.min(_id_key("doc_id")).alias("id"))
    ids = needed.join(texts, "c1").select("id").distinct()
    few = bloom.possible_hits(docs.withColumn("__id", _id_key(id_col)), "__id", bloom.build(ids, "id"))
    sets = (_with_sets(few, id_col, text_col).join(needed, "c1", "left_semi")
            .select("c1", "set").dropDuplicates(["c1"]))
    # read by class in three joins, so dealt by class once
    with bucketed(sets, "c1", spark_partitions(spark), "needed-sets") as sets:
        return roots_of(mine, sets)


def roots_of(mine: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of the links in the units ``mine`` of the classes ``sets``."""
    spark = mine.sparkSession

    def dealt(rows, *columns):
        rows = rows.repartition(spark_partitions(spark), "key", "i", "j").sortWithinPartitions("key", "i", "j", "c1")
        return rows.select("key", "i", "j", "c1", *columns)

    maps = materialize(sets.mapInArrow(_bitmaps, "c1 long, size long, bits binary"), "set-bitmaps")
    steps = dealt(mine.join(maps, "c1"), "size", "bits").mapInArrow(_likely, "key long, i long, j long, a long, b long")
    steps = materialize(steps, "likely-links")
    likely = steps.select("a", "b").distinct()
    first, second = (sets.select(F.col("c1").alias(c), F.col("set").alias(f"s{c}")) for c in "ab")
    shared = F.size(F.array_intersect("sa", "sb"))
    links = likely.join(first, "a").join(second, "b").filter(9 * shared >= 4 * (F.size("sa") + F.size("sb"))).select("a", "b")
    links = materialize(links, "links")
    roots = components(links)
    known = maps.join(roots.withColumnRenamed("node", "c1"), "c1", "left").withColumn("root", F.coalesce("root", "c1"))
    # a possible link between two roots has a step between two roots in its unit
    ends = [roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"]
    mixed = (steps.join(ends[0], "a", "left").join(ends[1], "b", "left")
             .filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("key", "i", "j").distinct())
    mixed = materialize(mixed, "mixed-units")
    left = dealt(mine.join(mixed, ["key", "i", "j"]).join(known, "c1"), "size", "bits", "root").mapInArrow(_undecided, "key long, i long, j long, c1 long")
    left = materialize(left, "undecided")
    if left.isEmpty():
        return roots
    same = left.groupBy("key", "i", "j").agg(F.count("*").alias("n"), *[
        F.sum(F.xxhash64("c1", F.lit(s)).cast("decimal(38,0)")).alias(f"s{s}") for s in (0, 1)])
    same = materialize(same.groupBy("n", "s0", "s1").agg(F.min(F.struct("key", "i", "j")).alias("u")).select("u.*"), "kept-units")
    more = dealt(left.join(same, ["key", "i", "j"]).join(sets, "c1"), "set").mapInArrow(_linked, "a long, b long")
    return components(links.unionByName(materialize(more, "more-links")))


def spark_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _components(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Per row with words: doc_id, r1, r2, n_shingles, class_id, component_id,
    root; and the ids of the rows without."""
    session(docs.sparkSession)
    keyed, shared = shared_buckets(_with_sets(docs, id_col, text_col))
    worded = keyed.filter("n_shingles > 0")
    roots = linked_classes(docs, worded, shared, id_col, text_col).withColumnRenamed("node", "c1")
    classes = worded.groupBy("c1", "c2").agg(F.min("doc_id").alias("class_id"))
    classes = materialize(classes.join(roots, "c1", "left").withColumn("root", F.coalesce("root", "c1")), "classes")
    smallest = materialize(classes.groupBy("root").agg(F.min("class_id").alias("component_id")), "components")
    classes = materialize(classes.join(smallest, "root").select("c1", "c2", "class_id", "root", "component_id"), "class-components")
    rows = worded.select("doc_id", "r1", "r2", "n_shingles", "c1", "c2").join(classes, ["c1", "c2"])
    return rows, keyed.filter("n_shingles = 0").select("doc_id", "n_shingles")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)
    and class_id (smallest doc_id with the same set)."""
    linked, alone = _components(docs, id_col, text_col)
    alone = alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    return linked.select("doc_id", "n_shingles", "component_id", "class_id").unionByName(alone)


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each component: the smallest
    id's (of equal ids, one digest's; of repeated rows, one).  Rows without
    words all stay.  Only rows that may go are shuffled."""
    linked, _ = _components(docs, id_col, text_col)
    each = linked.groupBy("root", "r1", "r2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    each = materialize(each, "component-rows")
    order = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "r1", "r2")
    first = materialize(each.groupBy("root").agg(F.min(order).alias("first")), "component-firsts")
    chosen = (F.col("r1") == F.col("first.r1")) & (F.col("r2") == F.col("first.r2"))
    special = (each.join(first, "root").filter(~chosen | (F.col("n") > 1))
               .select(F.col("r1").alias("__r1"), F.col("r2").alias("__r2"), chosen.alias("__stays")))
    special = materialize(special, "rows-to-drop")
    r1, r2 = _row_keys(id_col, text_col)
    named, filt = docs.select("*", r1.alias("__r1"), r2.alias("__r2")), bloom.build(special, "__r1")
    hits = bloom.possible_hits(named, "__r1", filt).join(special.hint("merge"), ["__r1", "__r2"], "left")
    once = hits.filter("__stays").dropDuplicates(["__r1", "__r2"])
    others = hits.filter("__stays is null").unionByName(bloom.sure_misses(named, "__r1", filt).withColumn("__stays", F.lit(None).cast("boolean")))
    return others.unionByName(once).select(*docs.columns)
