"""Byte-level BPE (operator 9): overlapping chunks, stitched pre-tokens.

A text longer than ``chunk`` characters is cut into chunks that overlap by
``overlap`` characters, and the chunks are pre-tokenised by different tasks.
A chunk that starts inside a pre-token may begin with false borders, but from
the first border that it shares with its predecessor on, both see the same
text from the same place, so their pre-tokens are the same: that is where the
two are stitched.  Borders in a chunk's last ``MARGIN`` characters are not
used, because the pattern may have looked past the chunk's end there.  Chunks
without a common border (one letter run or the like fills the overlap) stay
joined to their predecessor.  The pieces between the stitches are then encoded
by different tasks and their ids joined in order; decoding joins the tokens'
bytes.  Shorter texts are one piece and never leave their task, so only long
texts are shuffled.

Defined results: null counts as empty (no tokens, digests of nothing);
repeated rows stay repeated (a long text is encoded once per row); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import session, slices, text_of, tokenizer_path
from barsmith.session import materialize

CHUNK, OVERLAP, MARGIN = 1 << 16, 1 << 11, 8
SLICE_BYTES = 8 << 20

_LOADED: dict[str, Codec] = {}


class Codec:
    """Encoder and decoder of one rank file with a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.token = {i: t for t, i in ranks.items()}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))

    def borders(self, text: str) -> np.ndarray:
        """Ends of the pre-tokens, with 0."""
        return np.array([0, *(m.end() for m in self.pattern.finditer(text))], dtype=np.int64)


def codec(path: str, pattern: str) -> Codec:
    """One codec a worker process."""
    if path + pattern not in _LOADED:
        _LOADED[path + pattern] = Codec(path, pattern)
    return _LOADED[path + pattern]


def stitches(starts: list[int], ends: list[int], borders: list[np.ndarray]) -> list[int]:
    """Where the pieces of a text begin, from its chunks' spans and borders.

    ``borders`` are places in the text; each chunk's list may be cut to the
    overlaps with its neighbours.  The first chunk's borders are true."""
    cuts, true, last = [0], borders[0], ends[0]
    for k in range(1, len(starts)):
        common = np.intersect1d(true, borders[k], assume_unique=False)
        common = common[(common > starts[k]) & (common <= last - MARGIN) & (common > cuts[-1])]
        if len(common):
            cuts.append(int(common[0]))
            true, last = borders[k], ends[k]
        else:  # nothing is known of the borders here: what follows joins the last piece
            true, last = np.empty(0, dtype=np.int64), ends[k]
    return cuts


def _digest(c: Codec, ids: np.ndarray) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()


def encode_ids(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
               chunk: int = CHUNK, overlap: int = OVERLAP, digest: bool = False) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, as binary); or, with
    ``digest``, doc_id, n_tokens, ids_sha256, decoded_sha256."""
    if overlap <= MARGIN or chunk <= overlap:
        raise ValueError("chunk > overlap > MARGIN is needed")
    session(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, " + ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids binary")

    def result(c, ids, many):
        import pyarrow as pa

        if digest:
            cols = list(zip(*(_digest(c, x) for x in many), strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([ids, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                                               pa.array(cols[2], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes() for x in many], pa.binary())], names=["doc_id", "ids"])

    def short(batches: Iterable) -> Iterator:
        c = codec(path, pattern)
        for b in slices(batches, "text", SLICE_BYTES):
            yield result(c, b.column("doc_id"), [c.encode(t) for t in b.column("text").to_pylist()])

    def pretokenise(batches: Iterable) -> Iterator:
        import pyarrow as pa

        c = codec(path, pattern)
        for b in slices(batches, "part", SLICE_BYTES):
            found = []
            for start, part in zip(b.column("start").to_pylist(), b.column("part").to_pylist(), strict=True):
                at = c.borders(part) + start
                found.append(at[(at <= start + overlap) | (at >= start + chunk)])  # the overlaps
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("start"), pa.array([x.tolist() for x in found], pa.list_(pa.int64()))],
                                             names=["row", "start", "borders"])

    @F.udf("array<long>")
    def stitch(parts):
        parts = sorted(parts, key=lambda p: p["start"])
        starts = [p["start"] for p in parts]
        return stitches(starts, [s + chunk + overlap for s in starts], [np.array(p["borders"], dtype=np.int64) for p in parts])

    def encode(batches: Iterable) -> Iterator:
        import pyarrow as pa

        c = codec(path, pattern)
        for b in slices(batches, "part", SLICE_BYTES):
            ids = [c.encode(t).tobytes() for t in b.column("part").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("start"), pa.array(ids, pa.binary())], names=["row", "start", "ids"])

    def join(batches: Iterable) -> Iterator:
        import pyarrow as pa

        c = codec(path, pattern)
        for b in batches:
            for i, parts in enumerate(b.column("parts")):
                ids = b"".join(p["ids"] for p in sorted(parts.as_py(), key=lambda p: p["start"]))
                yield result(c, b.column("doc_id").slice(i, 1), [np.frombuffer(ids, dtype="<u4")])

    done = rows.filter(F.length("text") <= chunk).mapInArrow(short, out)
    long = rows.filter(F.length("text") > chunk)
    # written once: its row numbers are keys of two joins
    long = materialize(long.withColumn("row", F.monotonically_increasing_id()), "long-texts")
    chunks = (long.withColumn("start", F.explode(F.expr(f"sequence(0L, length(text) - 1L, {chunk}L)")))
              .select("row", "start", F.expr(f"substring(text, int(start) + 1, {chunk + overlap})").alias("part")))
    borders = chunks.repartition("row", "start").mapInArrow(pretokenise, "row long, start long, borders array<long>")
    cuts = borders.groupBy("row").agg(stitch(F.collect_list(F.struct("start", "borders"))).alias("cuts"))  # one text's
    pieces = (long.join(cuts, "row")
              .select("row", F.length("text").alias("n"), "text", "cuts", F.posexplode("cuts").alias("k", "start"))
              .select("row", "start", F.expr("substring(text, int(start) + 1, int(coalesce(try_element_at(cuts, k + 2), n) - start))").alias("part")))
    ids = pieces.repartition("row", "start").mapInArrow(encode, "row long, start long, ids binary")
    whole = ids.groupBy("row").agg(F.collect_list(F.struct("start", "ids")).alias("parts"))  # one text's
    return done.unionByName(long.select("row", "doc_id").join(whole, "row").select("doc_id", "parts").mapInArrow(join, out))


def decode_ids(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes: the inverse of :func:`encode_ids`."""
    session(rows.sparkSession)

    def decode(batches: Iterable) -> Iterator:
        import pyarrow as pa

        c = codec(path, pattern)
        for b in batches:
            raw = [None if x is None else c.decode(np.frombuffer(x, dtype="<u4")) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bytes binary")


def roundtrip(docs: DataFrame, name: str = "byte_bpe_multi_50k.tiktoken", **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 with the public files."""
    import public_tokenizers

    return encode_ids(docs, tokenizer_path(name), public_tokenizers.PATTERN, digest=True, **options)
