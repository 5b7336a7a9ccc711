"""Cross-tokenizer alignment (operator 13): interval coalescing.

A byte-level BPE (A) and a sentencepiece model (B) tokenise the same bytes, a
space and the text.  All tokens of a slice of documents are byte intervals:
they are sorted by start (lexsort), the running maximum of their ends is taken
(maximum.accumulate), and a group begins where a start reaches that maximum.
Within a group every A token is linked to every B token.

A worker encodes about ``ENCODE_BYTES`` of text at once and aligns slices of
about ``SLICE_BYTES`` of it.  A slice keeps its id pairs
once, and each document refers to them by place, with how often it holds them.
What leaves the worker for the corpus-wide counts is one row for each pair and
slice; they are summed (with map-side partial sums), the best count of each A
id is taken over its pairs (at most as many as B has ids), and the counts go
back to the slices, where each slice's documents add them up.  No group of
rows grows with the corpus: a pair has one row a slice, a slice is bounded.

A text longer than a slice is taken in pieces cut before a space between two
ASCII letters, where both tokenizers end a token.  A group whose links would be
more than ``WIDE`` is expanded over its distinct ids with multiplicities.

Defined results: null, empty, and texts whose A or B bytes differ from space +
text (the model may rewrite characters, U+2581 for one) have no tokens: zeros
and an empty digest; special strings are plain text for both; repeated rows
count each as a document; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.bpe_pairs import PairBPE, codec, gathered, pieces, spans, sums
from barsmith.llm.common import session, text_of, tokenizer_path
from barsmith.session import materialize

ENCODE_BYTES, SLICE_BYTES = 12 << 20, 3 << 20
WIDE = 1 << 16
MARK = "▁"

_LOADED: dict[str, Pieces] = {}


class Pieces:
    """A sentencepiece model's ids and the bytes they stand for."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        table = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        # pieces that span a blank would make it unsafe to cut long texts there
        self.cuttable = not any(MARK in p.lstrip(MARK) for i, p in enumerate(names) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
        self.lengths = np.array([len(t) for t in table], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, side by side, and where each text's end."""
        many = [np.array(self.sp.encode(t), dtype=np.int64) for t in texts]  # one text's list at a time
        return np.concatenate([*many, np.empty(0, dtype=np.int64)]), np.cumsum([len(x) for x in many], dtype=np.int64)


def loaded(path: str) -> Pieces:
    """One model a worker process."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


@dataclass
class Aligned:
    """The alignment of several texts; arrays have one entry a text, but for
    ``pair_*``, which list the distinct id pairs text after text."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    written: list[bytes]     # groups as text, closed by ";"
    pair_text: np.ndarray
    pair_code: np.ndarray    # A id * B's size + B id
    pair_times: np.ndarray


def _kept(ids: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the kept texts; the others' lists become empty."""
    n = np.where(keep, np.diff(ends, prepend=0), 0)
    return ids[np.repeat(keep, np.diff(ends, prepend=0))], np.cumsum(n)


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of A's and of B's tokens, given where they end (both
    cover the same bytes)."""
    ends = np.concatenate((a_ends, b_ends))
    starts = np.concatenate((np.append(0, a_ends[:-1]), np.append(0, b_ends[:-1])))[:len(ends)] if len(ends) else ends
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.append(True, starts[order][1:] >= reach[:-1]) if len(ends) else np.empty(0, dtype=bool)
    group = np.empty(len(ends), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group[:len(a_ends)], group[len(a_ends):]


def linked(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, text_a: np.ndarray, size_b: int):
    """(text, code, times) of the links: all pairs within each group, equal
    ones of a text counted together."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    first_b = np.cumsum(in_b) - in_b
    wide = in_a * in_b > WIDE
    text_of_group = text_a[np.cumsum(in_a) - in_a]
    small = ~wide[group_a]
    per_a = in_b[group_a][small]
    texts, codes = [np.repeat(text_a[small], per_a)], [np.repeat(a[small], per_a) * size_b + b[spans(first_b[group_a][small], per_a)]]
    times = [np.ones(len(codes[0]), dtype=np.int64)]
    for g in np.flatnonzero(wide):
        ua, ca = np.unique(a[np.searchsorted(group_a, g):np.searchsorted(group_a, g, "right")], return_counts=True)
        ub, cb = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
        codes.append((ua[:, None] * size_b + ub).ravel())
        times.append((ca[:, None] * cb).ravel())
        texts.append(np.full(len(codes[-1]), text_of_group[g]))
    return distinct(np.concatenate(texts), np.concatenate(codes), np.concatenate(times))


def distinct(text: np.ndarray, code: np.ndarray, times: np.ndarray):
    """Equal (text, code) rows become one, ``times`` added."""
    if not len(code):
        return text, code, times
    order = np.argsort(text * (int(code.max()) + 1) + code, kind="stable")
    text, code, times = text[order], code[order], times[order]
    last = np.flatnonzero(np.append((text[1:] != text[:-1]) | (code[1:] != code[:-1]), True))
    return text[last], code[last], np.diff(np.append(0, np.cumsum(times))[last + 1], prepend=0)


def _written(ids: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each closed by its byte of ``close``, and their lengths."""
    digits = np.char.mod("%d", np.arange(int(ids.max()) + 1)).astype("S") if len(ids) else np.empty(0, dtype="S1")
    width = digits.dtype.itemsize
    lengths = np.char.str_len(digits)[ids] + 1
    starts = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), dtype=np.uint8)
    table = digits.view(np.uint8).reshape(len(digits), width)
    for k in range(width):
        has = lengths > k + 1
        out[starts[has] + k] = table[ids[has], k]
    out[starts + lengths - 1] = close
    return out, lengths


def align(texts: list[str], a_codec: PairBPE, b_model: Pieces, encoded: tuple[np.ndarray, np.ndarray] | None = None) -> Aligned:
    """Alignment of texts that each begin with the space put before them;
    ``encoded``: their A ids and where each text's end, if known."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pa.array(texts, pa.string())
    sizes = np.asarray(pc.binary_length(column)).astype(np.int64)
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    # lossless: a byte-level vocabulary has every byte
    a, a_ends = encoded or a_codec.encode(column, specials=False)
    b, b_ends = b_model.encode([t[1:] for t in texts])
    valid = sums(b_model.lengths[b], b_ends) == sizes
    b, b_ends = _kept(b, b_ends, valid)
    # of those with the right length, the bytes must agree too
    same = b_model.bytes[spans(b_model.starts[b], b_model.lengths[b])] == data[np.repeat(valid, sizes)]
    agree = sums(same, np.cumsum(np.where(valid, sizes, 0))) == sizes
    b, b_ends = _kept(b, b_ends, valid & agree)
    valid &= agree
    a, a_ends = _kept(a, a_ends, valid)
    n_a, n_b = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    text_a, text_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
    group_a, group_b = groups_of(np.cumsum(a_codec.lengths[a]), np.cumsum(b_model.lengths[b]))
    first = np.append(True, group_a[1:] != group_a[:-1])[:len(group_a)]
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    group_ends = np.cumsum(np.bincount(text_a[first], minlength=len(texts)))
    # a group's A tokens, then its B tokens; ids, each with the sign behind it
    order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
    ids = np.concatenate((a, b))[order]
    close = np.full(len(ids), ord(","), dtype=np.uint8)
    close[np.cumsum(in_a + in_b) - in_b - 1] = ord("|")
    close[np.cumsum(in_a + in_b) - 1] = ord(";")
    out, lengths = _written(ids, close)
    ends = np.cumsum(sums(lengths, np.cumsum(n_a + n_b)))
    whole = out.tobytes()
    written = [whole[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    pair_text, pair_code, pair_times = linked(a, b, group_a, group_b, text_a, b_model.size)
    return Aligned(valid, n_a, n_b, np.diff(group_ends, prepend=0), sums(in_a * in_b, group_ends), written, pair_text, pair_code, pair_times)


def align_long(text: str, a_codec: PairBPE, b_model: Pieces, limit: int) -> Aligned:
    """Alignment of one long text, piece after piece."""
    parts = [align([p], a_codec, b_model) for p in (pieces(text, limit) if b_model.cuttable else [text])]
    if not all(p.valid[0] for p in parts):
        none, zero = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        return Aligned(np.zeros(1, dtype=bool), zero, zero, zero, zero, [b""], none, none, none)
    add = lambda name: sum(getattr(p, name) for p in parts)
    join = lambda name: np.concatenate([getattr(p, name) for p in parts])
    pairs = distinct(join("pair_text"), join("pair_code"), join("pair_times"))
    return Aligned(parts[0].valid, add("n_a"), add("n_b"), add("n_groups"), add("n_links"), [b"".join(p.written[0] for p in parts)], *pairs)


def aligned(batches: Iterable, a_codec: PairBPE, b_model: Pieces, encode_bytes: int, slice_bytes: int) -> Iterator:
    """(rows, texts, their alignment), slice after slice."""
    for t in gathered(batches, "text", encode_bytes):
        column = t.column("text").combine_chunks()
        if len(column) == 1 and len(column[0].as_py()) > slice_bytes:
            yield t, column.to_pylist(), align_long(column[0].as_py(), a_codec, b_model, slice_bytes)
            continue
        ids, ends = a_codec.encode(column, specials=False)
        at = 0
        for part in gathered(t.to_batches(), "text", slice_bytes):
            own = np.append(0, ends)[at:at + part.num_rows + 1]
            texts = part.column("text").to_pylist()
            yield part, texts, align(texts, a_codec, b_model, (ids[own[0]:own[-1]], own[1:] - own[0]))
            at += part.num_rows


def alignments(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text",
               encode_bytes: int = ENCODE_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Documents' own figures and, in rows of their own, the slices' pairs:
    slice, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links and times
    (binary, 32-bit: places in the slice's pairs, how often); or slice,
    codes, holders (distinct pairs, the slice's documents that hold them)."""
    session(docs.sparkSession)
    a_path, b_path = a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")
    # one space before each text: what both tokenise
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", F.when(F.col("text") != "", F.concat(F.lit(" "), "text")).otherwise("").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"slice long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, times binary, "
              "codes array<long>, holders array<long>")

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        a_codec, b_model = codec(a_path), loaded(b_path)
        number = TaskContext.get().partitionId() << 32
        for t, texts, x in aligned(batches, a_codec, b_model, encode_bytes, slice_bytes):
            codes, places, holders = np.unique(x.pair_code, return_inverse=True, return_counts=True)
            cuts = np.searchsorted(x.pair_text, np.arange(len(texts) + 1)).tolist()
            places, times = places.astype("<i4"), x.pair_times.astype("<i4")
            part = lambda v: [v[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]  # noqa: E731,B023
            sha = [hashlib.sha256(w[:-1]).hexdigest() if w else "" for w in x.written]
            out = {"slice": [number] * len(texts), "doc_id": t.column("doc_id"), "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups,
                   "n_links": x.n_links, "groups_sha256": sha, "links": part(places), "times": part(times)}
            lists = pa.list_(pa.int64())
            empty = pa.nulls(len(texts), lists)
            yield from pa.table({**out, "codes": empty, "holders": empty}).to_batches()
            null = {k: pa.nulls(1, t.schema.field("doc_id").type if k == "doc_id" else pa.array(v).type if k != "groups_sha256" else pa.string())
                    for k, v in out.items() if k != "slice"}
            yield pa.RecordBatch.from_pydict({"slice": [number], **null, "codes": pa.array([codes], lists), "holders": pa.array([holders], lists)})
            number += 1

    return rows.mapInArrow(run, schema)


def linked_counts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    size_b = loaded(options.get("b_path") or tokenizer_path("piece_bpe_32k.model")).size
    found = materialize(alignments(docs, **options), "alignments")  # slices are numbered as written
    pairs = found.filter(F.col("codes").isNotNull()).select(F.col("slice").alias("of"), F.posexplode(F.arrays_zip("codes", "holders")).alias("place", "p"))
    pairs = pairs.select("of", "place", F.col("p.codes").alias("code"), F.col("p.holders").alias("holders"))
    counts = pairs.groupBy("code").agg(F.sum("holders").alias("n"))
    # an A id has at most as many pairs as B has ids
    best = F.max("n").over(Window.partitionBy(F.floor(F.col("code") / size_b)))
    counts = counts.select("code", "n", (F.col("n") == best).alias("best"))
    back = pairs.select("of", "place", "code").join(counts, "code").select("of", "place", "n", "best")
    rows = found.filter(F.col("codes").isNull()).drop("codes", "holders")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def total(left, right):
        import pyarrow as pa

        place = right.column("place").to_numpy()
        n, is_best = np.zeros((2, len(place)), dtype=np.int64)
        n[place], is_best[place] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        held = [np.frombuffer(x, dtype="<i4") for x in left.column("links").to_pylist()]
        ends = np.cumsum([len(x) for x in held], dtype=np.int64)
        at = np.concatenate([*held, np.empty(0, dtype="<i4")])
        times = np.frombuffer(b"".join(left.column("times").to_pylist()), dtype="<i4").astype(np.int64)
        own = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        return (own.append_column("n_best", pa.array(sums(is_best[at] * times, ends), pa.int64()))
                .append_column("count_sum", pa.array(sums(n[at] * times, ends), pa.int64()))
                .append_column("groups_sha256", left.column("groups_sha256")))

    return (rows.groupBy("slice").cogroup(back.groupBy("of"))
            .applyInArrow(total, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
