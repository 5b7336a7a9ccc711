"""Line dedup (operator 10), DataFrame functions only: three-line windows.

The lines of a text that hold a word, trimmed, form overlapping windows of
three consecutive lines (a text with fewer lines is one window).  Windows are
compared over all documents by a 128-bit hash.  A window found more than once
keeps its first occurrence - by id, then text, then place - and its later
occurrences are removed: their line ranges, white lines in between included,
are merged and cut out of the text.  Every removed line stands in an earlier
place, so the first copy of each line survives.

Per document only ranges travel: the windows' hashes are shuffled once, first
occurrences are combined before that shuffle, and the ranges come back to the
texts by an equi-join that only texts pass which a Bloom filter of the changed
documents lets through; the others are not shuffled.  Both joins read written
tables, so AQE can split a window or document that is repeated very often.

Defined results: null texts stay null and have no lines; empty texts stay
empty; rows equal in id and text are one document (repeated rows keep or lose
the same lines); null ids come first in order; an empty table gives no rows;
other columns are kept (:func:`dedup`) whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm import bloom
from barsmith.llm.common import session
from barsmith.session import materialize

WIDTH = 3
WHITE = " \t\n\x0b\x0c\r"


def _bound(value: Column, body) -> Column:
    """body(value), with ``value`` evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def full_lines(lines: Column) -> Column:
    """(l, i): trimmed lines that hold a word, with their 0-based places."""
    each = F.transform(lines, lambda s, i: F.struct(F.btrim(s, F.lit(WHITE)).alias("l"), i.alias("i")))
    return F.filter(each, lambda x: x["l"] != "")


def _windows(full: Column) -> Column:
    """(h1, h2, s, e): each window's hash and the places of its first and
    last line."""
    def window(x, at, n):
        part = F.transform(F.slice(x, at, n), lambda y: y["l"])
        return F.struct(F.xxhash64(part).alias("h1"), F.xxhash64(part, F.lit(1)).alias("h2"),
                        F.get(x, at - 1)["i"].alias("s"), F.get(x, at + n - 2)["i"].alias("e"))

    def of(x):
        n = F.size(x)
        several = F.transform(F.sequence(F.lit(1), n - (WIDTH - 1)), lambda at: window(x, at, F.lit(WIDTH)))
        return F.when(n >= WIDTH, several).when(n > 0, F.array(window(x, F.lit(1), n)))

    return _bound(full, of)


def _keys(id_col: str, text_col: str) -> list[Column]:
    """A document's identity, never null."""
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("__k1"), F.xxhash64(F.col(text_col), F.lit(3), F.col(id_col)).alias("__k2")]


def later_ranges(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__k1, __k2, __cut): sorted line ranges to remove of each document that
    loses any."""
    texts = docs.select(F.col(id_col).alias("id"), *_keys(id_col, text_col),
                        F.explode(_windows(full_lines(F.split(F.col(text_col), "\n")))).alias("w"))
    place = F.struct("id", "__k1", "__k2", F.col("w.s").alias("s"))
    seen = materialize(texts.select("w.h1", "w.h2", place.alias("place"), F.col("w.e").alias("e")), "line-windows")
    first = seen.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    first = materialize(first.drop("last"), "repeated-windows")
    later = seen.join(first, ["h1", "h2"]).filter("first < place")
    ranges = later.groupBy("place.__k1", "place.__k2").agg(F.sort_array(F.collect_set(F.struct("place.s", "e"))).alias("__cut"))  # one document's
    return materialize(ranges, "later-ranges")


def without_ranges(lines: Column, cut: Column) -> Column:
    """The lines outside the sorted ranges, whose ends are sorted too."""
    def gaps(x):
        n = F.size(x[1])

        def gap(k):
            begin = F.when(k == 0, 0).otherwise(F.get(x[1], k - 1)["e"] + 1)
            end = F.when(k == n, F.size(x[0])).otherwise(F.get(x[1], k)["s"])
            return F.slice(x[0], begin + 1, F.greatest(end - begin, F.lit(0)))

        return F.flatten(F.transform(F.sequence(F.lit(0), n), gap))

    pair = F.struct(lines.alias("a"), cut.alias("b"))
    return _bound(pair, lambda p: gaps((p["a"], p["b"])))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the text after removal, and ``__n_lines``
    (lines with a word before), ``__n_removed`` of those."""
    session(docs.sparkSession)
    ranges = later_ranges(docs, id_col=id_col, text_col=text_col)
    named, changed = docs.select("*", *_keys(id_col, text_col)), bloom.build(ranges, "__k1")
    rows = bloom.possible_hits(named, "__k1", changed).join(ranges.hint("merge"), ["__k1", "__k2"], "left")
    others = bloom.sure_misses(named, "__k1", changed).withColumn("__cut", F.lit(None).cast(ranges.schema["__cut"].dataType))
    rows = rows.unionByName(others)
    lines = F.split(F.col(text_col), "\n")
    left = F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(F.array_join(without_ranges(lines, F.col("__cut")), "\n"))
    count = lambda c: F.coalesce(F.size(F.filter(F.split(c, "\n"), lambda s: F.btrim(s, F.lit(WHITE)) != "")), F.lit(0))
    out = rows.withColumn("__left", left)
    n = F.when(F.col(text_col).isNull(), 0).otherwise(count(F.col(text_col)))
    kept = F.when(F.col(text_col).isNull(), 0).otherwise(count(F.col("__left")))
    return out.select(*[F.col("__left").alias(c) if c == text_col else F.col(c) for c in docs.columns],
                      n.cast("long").alias("__n_lines"), (n - kept).cast("long").alias("__n_removed"))


def keep_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs``, the same columns, with the texts after removal; documents
    that lose all their lines go.  ``chars_col``, if there, follows the text."""
    out = dedup(docs, id_col=id_col, text_col=text_col)
    out = out.filter((F.col("__n_removed") == 0) | (F.col("__n_removed") < F.col("__n_lines")))
    chars = F.when(F.col("__n_removed") > 0, F.length(text_col).cast("long")).otherwise(F.col(chars_col)) if chars_col in docs.columns else None
    return out.select(*[chars.alias(c) if c == chars_col else F.col(c) for c in docs.columns])
