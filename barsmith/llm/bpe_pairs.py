"""BPE encoding and decoding (operator 12): pair occurrence index.

Arrow batches are gathered to slices of ``SLICE_BYTES`` of text.  A slice's
texts are cut into pre-tokens at once: every code point has one of four
classes (letter, number, white space, other), pre-tokens are runs of a class,
and two rules move borders (the last blank of a run of white space goes to the
run that follows; an apostrophe takes the English endings ``s t m d re ve
ll``).  The classes are asked of the library's own pre-tokeniser, once for each
code point that occurs.  The distinct pre-tokens of the slice then lie side by
side in one array of symbols with links to their neighbours, and an index maps
each mergeable pair to all its positions.  Active ranks are taken in ascending
order: all positions of the rank's pair are merged together (in a run of equal
symbols every second one), and the pairs that arise are added to the lists of
their ranks.  That needs one pass because a pair's rank is always higher than
those that made its parts; :class:`PairBPE` proves this from the vocabulary
and refuses it otherwise.  Decoding joins the tokens' bytes.

The operator is map-only.  A text longer than a slice is encoded in pieces
cut before a space between two ASCII letters, where a pre-token always ends.

Defined results: null counts as empty (no tokens, digests of nothing);
repeated rows stay repeated; an empty table gives no rows; other columns are
ignored.  Special tokens inside a text become their ids unless ``specials`` is
off.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import session, text_of, tokenizer_path

SLICE_BYTES = 16 << 20
SAFE_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
# The endings an apostrophe takes, as the pre-token pattern has them.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")

_LOADED: dict[str, PairBPE] = {}


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters for themselves, the others, in order, from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all elements of the spans, one span after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the consecutive parts of ``values`` that end at ``ends``."""
    total = np.append(0, np.cumsum(values))[ends]
    return np.diff(total, prepend=0)


def pieces(text: str, limit: int) -> Iterator[str]:
    """The text in parts of ``limit`` characters or a little more, cut where
    a pre-token surely ends (not at all if there is no such place)."""
    at = 0
    while len(text) - at > limit and (cut := SAFE_CUT.search(text, at + limit)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


class PairBPE:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        added = spec["added_tokens"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or spec["normalizer"] or spec["post_processor"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] \
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("only plain byte-level BPE vocabularies are handled")
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left, self.right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self._prove()
        keys = self.left * self.size + self.right
        self.rank_order = np.argsort(keys)
        self.keys = keys[self.rank_order]
        chars = byte_chars()
        self.of_byte = np.array([vocab[c] for c in chars], dtype=np.int64)
        back = {c: b for b, c in enumerate(chars)}
        table = [b""] * self.size
        for token, i in vocab.items():
            table[i] = bytes(back[c] for c in token)
        for t in added:
            table[t["id"]] = t["content"].encode()
        self.lengths = np.array([len(t) for t in table], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.special_ids = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special_ids, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first)).encode()) if added else None
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.classes = np.zeros(0x110000, dtype=np.uint8)

    def _prove(self) -> None:
        """Each token is made by one pair, whose parts were made before."""
        made_at = np.full(self.size, -1, dtype=np.int64)
        made_at[self.made] = np.arange(len(self.made))
        order = np.arange(len(self.made))
        if len(np.unique(self.made)) < len(self.made) or (made_at[self.left] >= order).any() or (made_at[self.right] >= order).any():
            raise ValueError("ranks do not rise from parts to wholes")

    # ---- pre-tokens -----------------------------------------------------
    def _learn(self, codes: np.ndarray) -> None:
        """Asks the library for the classes of code points not met so far."""
        new = np.flatnonzero(np.bincount(codes, minlength=0x110000)[:0x110000].astype(bool) & (self.classes == 0))
        for c in new.tolist():
            kinds = [k for k, probe in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.library.pre_tokenize_str(probe + chr(c))) == 1]
            self.classes[c] = kinds[0] if kinds else SPACE

    def borders(self, data: bytes, first: np.ndarray) -> np.ndarray:
        """Byte places where pre-tokens begin; ``first``: where texts (or
        parts that nothing crosses) begin."""
        codes = np.frombuffer(data.decode().encode("utf-32-le"), dtype=np.uint32)
        n = len(codes)
        if not n:
            return np.empty(0, dtype=np.int64)
        self._learn(codes)
        kind = self.classes[codes]
        at = np.cumsum(1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000))
        at = np.append(0, at[:-1])
        fresh = np.zeros(n + 1, dtype=bool)
        fresh[np.searchsorted(at, first[first < len(data)])] = True
        fresh[n] = True
        begin = fresh.copy()
        begin[1:n] |= kind[1:] != kind[:-1]
        runs = np.flatnonzero(begin[:n])
        ends = np.append(runs[1:], n)
        # white space before something else: its last character stands alone, a blank joins what follows
        blank = ends[(kind[runs] == SPACE) & ~fresh[ends]]
        begin[blank - 1] = True
        begin[blank[codes[blank - 1] == 0x20]] = False
        # an apostrophe that begins a pre-token takes an ending
        quote = runs[(codes[runs] == 0x27) & (ends - runs == 1) & begin[runs]]
        for ending in ENDINGS:
            k = len(ending)
            q = quote[quote + k < n]
            for j, c in enumerate(ending, 1):
                q = q[(codes[q + j] == ord(c)) & ~fresh[q + j]]
            begin[q + 1] = False
            begin[q + 1 + k] = True
        return at[begin[:n]]

    # ---- merges ---------------------------------------------------------
    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; -1 for pairs that never merge."""
        keys = a * self.size + b
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, self.rank_order[i], -1)

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words, whose symbols lie side by side and end at
        ``ends``, and where each word's ids end."""
        n = len(symbols)
        if not n:
            return symbols, ends
        sym = symbols.copy()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends[ends > 0] - 1] = -1
        before[ends[ends < n]] = -1
        index: dict[int, list[np.ndarray]] = {}  # rank of a pair -> all its positions

        def add(positions: np.ndarray, ranks: np.ndarray) -> list[int]:
            """Enters positions into the lists; the ranks that are new."""
            positions, ranks = positions[ranks >= 0], ranks[ranks >= 0]
            if len(ranks) > 1:
                order = np.argsort(ranks, kind="stable")
                positions, ranks = positions[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            new = []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i < j:
                    r = int(ranks[i])
                    if r not in index:
                        index[r] = []
                        new.append(r)
                    index[r].append(positions[i:j])
            return new

        at = np.flatnonzero(after >= 0)
        active = add(at, self._ranks(sym[at], sym[at + 1]))
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            a, b, whole = self.left[rank], self.right[rank], self.made[rank]
            lists = index.pop(rank)
            p = lists[0] if len(lists) == 1 else np.concatenate(lists)
            p = p[sym[p] == a]
            q = after[p]
            ok = q >= 0
            ok &= sym[q] == b  # q = -1 reads the last symbol, which `ok` leaves out
            p, q = p[ok], q[ok]
            if a == b and len(p) > 1:  # of a run of equal symbols every second pair
                p = np.sort(p)
                chained = np.append(False, after[p[:-1]] == p[1:])
                place = np.arange(len(p))
                p = p[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
                q = after[p]
            if not len(p):
                continue
            beyond, lead = after[q], before[p]
            sym[p], sym[q], after[p] = whole, -1, beyond
            has = beyond >= 0
            before[beyond[has]] = p[has]
            lead = lead[lead >= 0]
            lead = lead[sym[lead] != whole]  # two new tokens side by side: entered once, below
            right = p[has]
            where = np.concatenate((right, lead))
            if len(where):
                for r in add(where, self._ranks(sym[where], sym[after[where]])):
                    heapq.heappush(active, r)
        alive = sym >= 0
        return sym[alive], np.append(0, np.cumsum(alive))[ends]

    # ---- texts ----------------------------------------------------------
    def encode(self, texts, *, specials: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow string array without nulls, side by side, and
        where each text's ids end."""
        import pyarrow as pa
        import pyarrow.compute as pc

        text_ends = np.cumsum(np.asarray(pc.binary_length(texts)), dtype=np.int64)
        data = b"".join(s.encode() for s in texts.to_pylist())
        first, marks = np.append(0, text_ends), []
        if specials and self.special:
            crossed = lambda m: np.searchsorted(text_ends, m.start(), "right") != np.searchsorted(text_ends, m.end(), "left")
            found = list(self.special.finditer(data))
            if any(map(crossed, found)):  # a match over two texts' border could hide one inside a text
                lows = np.append(0, text_ends[:-1])
                found = [m for i, j in zip(lows.tolist(), text_ends.tolist(), strict=True) for m in self.special.finditer(data, i, j)]
            marks = found
            first = np.concatenate([first, [m.start() for m in marks], [m.end() for m in marks]]).astype(np.int64)
        begin = self.borders(data, first)
        if not len(begin):
            return np.empty(0, dtype=np.int64), np.zeros(len(text_ends), dtype=np.int64)
        if marks:  # a special token is one pre-token
            lows, highs = (np.searchsorted(begin, [f(m) for m in marks]) for f in (lambda m: m.start(), lambda m: m.end()))
            begin = np.delete(begin, spans(lows + 1, highs - lows - 1))
        offsets = pa.py_buffer(np.append(begin, len(data)).astype(np.int32))
        coded = pa.Array.from_buffers(pa.binary(), len(begin), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        words = coded.dictionary
        word_ends = np.cumsum(np.asarray(pc.binary_length(words)), dtype=np.int64)
        raw = np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8)
        ids, ends = self.merge(self.of_byte[raw], word_ends)
        which = np.asarray(coded.indices).astype(np.int64)
        if marks:
            which[np.searchsorted(begin, [m.start() for m in marks])] = len(words) + np.arange(len(marks))
            own = np.array([self.special_ids[m.group().decode()] for m in marks])
            ids, ends = np.append(ids, own), np.append(ends, len(ids) + 1 + np.arange(len(marks)))
        lengths = np.diff(ends, prepend=0)
        per_token = lengths[which]
        out = ids[spans((ends - lengths)[which], per_token)]
        return out, np.append(0, np.cumsum(per_token))[np.searchsorted(begin, text_ends)]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[spans(self.starts[ids], self.lengths[ids])].tobytes()


def codec(path: str) -> PairBPE:
    """One codec a worker process."""
    if path not in _LOADED:
        _LOADED[path] = PairBPE(path)
    return _LOADED[path]


def gathered(batches: Iterable, column: str, max_bytes: int) -> Iterator:
    """Arrow batches joined or cut to slices of about ``max_bytes`` of
    ``column``; a longer value comes alone."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held, size = [], 0
    for b in batches:
        ends = np.append(0, np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)), dtype=np.int64))
        i = 0
        while i < b.num_rows:
            j = int(np.searchsorted(ends, ends[i] + max_bytes - size, side="right")) - 1
            if j > i:
                held.append(b.slice(i, j - i))
                size += int(ends[j] - ends[i])
                i = j
            elif held:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            else:
                yield pa.Table.from_batches([b.slice(i, 1)])
                i += 1
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def encoded(c: PairBPE, texts, max_bytes: int, specials: bool) -> list[np.ndarray]:
    """The ids of each text of a slice."""
    import pyarrow as pa

    if len(texts) == 1 and len(texts[0].as_py()) > max_bytes:
        parts = [c.encode(pa.array([t]), specials=specials)[0] for t in pieces(texts[0].as_py(), max_bytes)]
        return [np.concatenate(parts)]
    ids, ends = c.encode(texts, specials=specials)
    return np.split(ids, ends[:-1])


def encode_ids(docs: DataFrame, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", specials: bool = True,
               digest: bool = False, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, as binary); or, with
    ``digest``, doc_id, n_tokens, ids_sha256, decoded_sha256."""
    session(docs.sparkSession)
    path = path or tokenizer_path("byte_bpe_50k.json")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def encode(tables: Iterable) -> Iterator:
        import pyarrow as pa

        c = codec(path)
        for t in gathered(tables, "text", slice_bytes):
            many = [x.astype("<u4") for x in encoded(c, t.column("text").combine_chunks(), slice_bytes, specials)]
            if digest:
                cols = {"n_tokens": pa.array([len(x) for x in many], pa.int64()), "ids_sha256": pa.array([sha(x.tobytes()) for x in many], pa.string()),
                        "decoded_sha256": pa.array([sha(as_text(c.decode(x)).encode()) for x in many], pa.string())}
            else:
                cols = {"ids": pa.array([x.tobytes() for x in many], pa.binary())}
            yield from pa.table({"doc_id": t.column("doc_id"), **cols}).to_batches()

    return rows.mapInArrow(encode, f"doc_id {kind}, " + ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids binary"))


def as_text(raw: bytes) -> str:
    """Bytes that are no UTF-8 (ids cut inside a character) become U+FFFD."""
    return raw.decode("utf-8", "replace")


def decode_ids(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text: the inverse of :func:`encode_ids` (null ids: null)."""
    session(rows.sparkSession)
    path = path or tokenizer_path("byte_bpe_50k.json")

    def decode(batches: Iterable) -> Iterator:
        import pyarrow as pa

        c = codec(path)
        for b in batches:
            texts = [None if x is None else as_text(c.decode(np.frombuffer(x, dtype="<u4"))) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
