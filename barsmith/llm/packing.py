"""Packing (operator 4): order-preserving dynamic programming over cuts.

The documents' tokens, in the order in which the table's partitions hold the
documents, form streams (one a partition).  A stream is cut into windows of at
most ``size`` tokens.  Cuts may lie at document ends (free), at sentence ends
(a small penalty) and, only where a sentence leaves no other choice, every
``FILL`` tokens (a large one); the plan that minimises padding plus penalties
is found by dynamic programming over the possible cuts:

    cost(j) = penalty(j) + min over i with pos(j) - pos(i) <= size of
              cost(i) + padding(pos(j) - pos(i))

Padding is size - length, so the minimum over i is a sliding-window minimum of
cost(i) + pos(i), which a monotone queue keeps in constant time a step.  A
window whose length is a power of two needs no padding; the halves, quarters
and eighths of the size are looked up one by one.

A task holds at most ``BUFFER`` tokens besides one Arrow slice: when the buffer
is full the plan is fixed up to ``HOLD`` windows before its end, and what
follows the last fixed cut stays in the buffer.  Nothing is shuffled; a lost
task is redone from its own partition with the same result.

Token ids come from the tokenizers library.  The vocabulary's words are
encoded once each: texts are normalised and cut into words by Arrow, and a
word's ids come from a cache that the library fills (the border of two words
stops every merge, as :class:`WordIds` states).  Texts with anything that
Arrow might treat otherwise than the library - special strings, rare letters -
are given to the library whole.

Defined results: null counts as empty, so a null or empty text is its one end
token; repeated rows and ids stay repeated; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import session, slices, text_of, tokenizer_path

SIZE = 4096
END = 2  # id behind every document
BUFFER = 600_000
HOLD = 16
FILL = 512
APART = 32
SENTENCE_COST, FILL_COST = 8, 200
SLICE_BYTES = 12 << 20
CACHE = 500_000


class WordIds:
    """Ids of whole texts, word by word, as the library gives them.

    The model lower-cases, turns white space into single spaces and cuts at
    them and between letters, single digits and other marks before merging, so
    ids of a text are the ids of its words one after the other.  What stands
    between two spaces is looked at once while it stays in the cache."""

    # A text goes to the library whole unless it consists of these: ASCII but
    # the apostrophe (whose contractions cross the borders below) and Latin
    # letters whose lower case is one composed letter in both libraries.
    PLAIN = r"^[\t\n\r -&(-~À-ÖØ-öø-įĲ-ńŊ-ž]*$"
    # letters in runs, digits alone, all else in runs
    WORDS = re.compile(r"[a-zß-öø-ÿā-ž]+|[0-9]|[^0-9a-zß-öø-ÿā-ž]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.special = sorted(t.content for t in self.library.get_added_tokens_decoder().values())
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            bare = token.removesuffix("</w>")
            self.ends[i] = token != bare and bare[:1] in ".!?" and set(bare) <= set(".!?\")'")
        # the letter that stands for each byte, from the library itself
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letter = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(128)}
        for c in range(128, 2048):  # two bytes each
            for b, x in zip(chr(c).encode(), byte_level.pre_tokenize_str(chr(c))[0][0], strict=True):
                letter[b] = x
        self.letters = "".join(letter.get(b, "\x00") for b in range(256))
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.flat, self.offsets = array("I"), array("q", [0, 0])
        self.words: dict[str, tuple[int, ...]] = {}

    def _of_word(self, word: str) -> tuple[int, ...]:
        ids = self.words.get(word)
        if ids is None:
            ids = tuple(t.id for t in self.library.model.tokenize(word.encode().decode("latin-1").translate(self.letters)))
            self.words[word] = ids
        return ids

    def _places(self, parts: list[str]) -> np.ndarray:
        """Where the ids of each part are in the cache, filling it."""
        if len(self.place) > CACHE:
            self._clear()
        place, flat, offsets, of_word = self.place, self.flat, self.offsets, self._of_word
        for p in parts:
            if p not in place:
                place[p] = len(offsets) - 1
                for w in self.WORDS.findall(p):
                    flat.extend(of_word(w))
                offsets.append(len(flat))
        return np.fromiter(map(place.__getitem__, parts), dtype=np.int64, count=len(parts))

    def of_texts(self, texts) -> list[np.ndarray]:
        """Ids of each text of an Arrow string array without nulls."""
        import pyarrow.compute as pc

        plain = pc.match_substring_regex(texts, self.PLAIN)
        for s in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(texts, s)))
        plain = plain.to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(pc.if_else(plain, texts, ""))
        for white in "\t\n\r":
            low = pc.replace_substring(low, white, " ")
        parts = pc.split_pattern(low, " ")
        coded = parts.flatten().dictionary_encode()
        places = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat, offsets = np.array(self.flat, dtype="<u4"), np.array(self.offsets, dtype=np.int64)
        at = places[coded.indices.to_numpy()]
        n = offsets[at + 1] - offsets[at]
        total = np.append(0, np.cumsum(n))
        ids = flat[np.repeat(offsets[at] - total[:-1], n) + np.arange(total[-1])]
        bounds = parts.offsets.to_numpy().astype(np.int64)
        ends = total[bounds - bounds[0]]
        out = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for i in np.flatnonzero(~plain):
            out[i] = self.whole(texts[int(i)].as_py())
        return out

    def whole(self, text: str, chunk: int = 1 << 16) -> np.ndarray:
        """The library's ids; a long text in chunks cut before white space,
        where no word, composition or special string is cut."""
        parts, i = [], 0
        while i < len(text):
            j = i + chunk
            while j < len(text) and text[j] not in " \n\t":
                j += 1
            parts.append(self.library.encode(text[i:j], add_special_tokens=False).ids)
            i = j
        return np.array([x for p in parts for x in p], dtype="<u4")


def plan(cuts: np.ndarray, costs: np.ndarray, size: int = SIZE) -> list[int]:
    """Indices into ``cuts`` of the best window ends.

    ``cuts``: increasing positions, first 0, neighbours at most ``size``
    apart; ``costs``: the penalty of cutting there."""
    n = len(cuts)
    pos, pen = cuts.tolist(), costs.tolist()
    powers = [size >> k for k in (1, 2, 3) if size & (size - 1) == 0 and size >> k]
    index = {p: i for i, p in enumerate(pos)}
    best, back, value = [0.0] * n, [0] * n, [0.0] * n
    queue, head = [0], 0  # indices with increasing cost + position
    value[0] = float(pos[0])
    get = index.get
    for j in range(1, n):
        p = pos[j]
        while pos[queue[head]] < p - size:
            head += 1
        i = queue[head]
        cost = value[i] + size - p
        for w in powers:
            k = get(p - w)
            if k is not None and best[k] < cost:
                cost, i = best[k], k
        cost += pen[j]
        best[j], back[j] = cost, i
        v = cost + p
        value[j] = v
        while len(queue) > head and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
        if head > 4096:
            del queue[:head]
            head = 0
    ends, j = [], n - 1
    while j:
        ends.append(j)
        j = back[j]
    return ends[::-1]


class Stream:
    """Documents in, pieces out; holds the tokens behind the last fixed cut."""

    def __init__(self, first_sequence: int, ends: np.ndarray, size: int):
        self.sequence, self.ends, self.size = first_sequence, ends, size
        self.docs: list[tuple[object, np.ndarray, int]] = []  # id, all its tokens, tokens already packed
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids)
        return self.flush(final=False) if self.held >= BUFFER else []

    def _cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """Possible cuts and their penalties, from 0 to the tokens held."""
        at, cost, base = [np.zeros(1, dtype=np.int64)], [np.zeros(1)], 0
        for _, ids, done in self.docs:
            rest = ids[done:]
            sentence = np.flatnonzero(self.ends[rest[:-1]]) + 1
            # of sentence ends close together, the last is enough
            sentence = sentence[np.append(sentence[1:] // APART != sentence[:-1] // APART, True)] if len(sentence) else sentence
            marks = np.append(np.append(0, sentence), len(rest))
            wide = np.flatnonzero(np.diff(marks) > self.size // 4)  # too far apart to meet the window's end
            fill = [np.arange(marks[w] + FILL, marks[w + 1], FILL) for w in wide]
            fill = np.concatenate([*fill, np.empty(0, dtype=np.int64)])
            places = np.concatenate([sentence, fill, [len(rest)]])
            prices = np.concatenate([np.full(len(sentence), SENTENCE_COST), np.full(len(fill), FILL_COST), [0]])
            order = np.argsort(places, kind="stable")
            at.append(base + places[order])
            cost.append(prices[order].astype(float))
            base += len(rest)
        return np.concatenate(at), np.concatenate(cost)

    def flush(self, final: bool) -> list[tuple]:
        if not self.docs:
            return []
        cuts, costs = self._cuts()
        ends = cuts[plan(cuts, costs, self.size)]
        if not final:
            ends = ends[:-HOLD]
        pieces, k, base = [], 0, 0
        begin, offset = 0, 0
        for d, (doc_id, ids, done) in enumerate(self.docs):
            stop = base + len(ids) - done
            while k < len(ends) and begin < stop:
                end = min(stop, int(ends[k]))
                a, b = done + begin - base, done + end - base
                pieces.append((doc_id, a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids), self.sequence, offset))
                offset += end - begin
                begin = end
                if end == ends[k]:
                    k, offset, self.sequence = k + 1, 0, self.sequence + 1
            if k == len(ends):
                left = [(doc_id, ids, done + begin - base)] if begin < stop else []
                self.docs = left + self.docs[d + 1:]
                break
            base = stop
        self.held = sum(len(x) - done for _, x, done in self.docs)
        return pieces


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, path: str | None = None, *, size: int = SIZE, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  Sequence ids are the partition's number * 2**40 plus
    a count, so they are unique without a shuffle."""
    session(docs.sparkSession)
    path = path or tokenizer_path("word_bpe_49k.json")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterable) -> Iterator:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import pyarrow as pa
        from pyspark import TaskContext

        words = loaded(path)
        stream = Stream(TaskContext.get().partitionId() << 40, words.ends, size)
        id_type = None

        def out(pieces):
            cols = list(zip(*pieces, strict=True)) or [[]] * len(COLUMNS)
            arrays = [pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])]
            return pa.RecordBatch.from_arrays(arrays, names=list(COLUMNS))

        for b in slices(batches, "text", SLICE_BYTES):
            id_type, pieces = b.schema.field("doc_id").type, []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), words.of_texts(b.column("text")), strict=True):
                pieces += stream.add(doc_id, np.append(ids, np.array([end], dtype="<u4")))
            if pieces:
                yield out(pieces)
        if id_type is not None:
            yield out(stream.flush(final=True))

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in COLUMNS[1:]))


_LOADED: dict[str, WordIds] = {}


def loaded(path: str) -> WordIds:
    """One vocabulary a worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
