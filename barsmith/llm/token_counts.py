"""Token counts (operator 2): whole-token shortcut for a piece vocabulary.

The model escapes a space as U+2581 and puts one in front of the text; no
piece holds that mark after another character, and none holds a line feed, so
merges never cross the border before a run of marks or around a line feed.
:class:`Shortcut` proves both from the vocabulary (and refuses the model
otherwise), then encodes every vocabulary string alone with the library and
keeps those that come back as the one token: a pre-token among them counts 1
without any merging.  All other distinct pre-tokens are merged by the library,
once each.

Texts are cut into pre-tokens by Arrow's regular expressions and
dictionary-encoded, so per-word work is done once per distinct pre-token of a
slice.  The operator is map-only: no shuffle, a worker holds one slice
(``SLICE_BYTES`` of text, or a single longer text) at a time.

Defined results: null counts as empty (0 bytes, 0 tokens); repeated rows stay
repeated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import session, slices, text_of, tokenizer_path

MARK = "▁"  # the model's escaped space
CUT = "\x01"  # put behind each pre-token; texts that hold it go to the library whole
PRETOKEN = f"({MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+)"
SLICE_BYTES = 8 << 20
CACHE = 300_000  # merged counts a worker keeps; beyond that it starts anew


class Shortcut:
    """Token counts of one sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.whole = self._prove()
        self.merged: dict[str, int] = {}

    def _prove(self) -> frozenset[str]:
        """The pre-tokens that are one token."""
        sp = self.sp
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        pieces = [sp.id_to_piece(i) for i in ids]
        odd = [p for p in pieces if "\n" in p or MARK in p.lstrip(MARK)]
        if odd or sp.encode("a b", out_type=str)[0][:1] != MARK:
            raise ValueError(f"pieces that cross pre-token borders, or no dummy prefix: {odd[:5]}")
        counts = self._merge_many(pieces)
        return frozenset(p for p, n in zip(pieces, counts, strict=True) if n == 1 and CUT not in p)

    def _merge_many(self, pretokens: list[str]) -> list[int]:
        """The library's own counts; each pre-token is encoded behind what
        gives it the left border that it has in a text."""
        # "x" + run of marks: the dummy prefix joins "x", which no piece joins to a mark
        behind = ["x" + p.replace(MARK, " ") if p[:1] == MARK else "\n" + p for p in pretokens]
        lead = {True: len(self.sp.encode("x")), False: len(self.sp.encode("\n"))}
        return [len(ids) - lead[p[:1] == MARK]
                for p, ids in zip(pretokens, self.sp.encode(behind, num_threads=1), strict=True)]

    def of_distinct(self, pretokens: list[str]) -> np.ndarray:
        out, whole, merged = np.ones(len(pretokens), dtype=np.int64), self.whole, self.merged
        if len(merged) > CACHE:
            merged.clear()
        rest = [i for i, p in enumerate(pretokens) if p not in whole and p != "\n"]
        new = [p for p in (pretokens[i] for i in rest) if p not in merged]
        if new:
            merged.update(zip(new, self._merge_many(new), strict=True))
        for i in rest:
            out[i] = merged[pretokens[i]]
        return out

    def count(self, texts) -> np.ndarray:
        """Tokens of each text of an Arrow string array without nulls."""
        import pyarrow.compute as pc

        odd = pc.match_substring(texts, CUT).to_numpy(zero_copy_only=False)
        marked = pc.binary_join_element_wise(MARK, pc.replace_substring(texts, " ", MARK), "")
        marked = pc.if_else(odd, "", marked)
        pretokens = pc.split_pattern(pc.replace_substring_regex(marked, PRETOKEN, f"\\1{CUT}"), CUT)
        coded = pretokens.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        per_word = self.of_distinct([w or "\n" for w in words])
        per_word[[i for i, w in enumerate(words) if not w]] = 0  # behind the last cut
        each = np.append(0, np.cumsum(per_word[coded.indices.to_numpy()]))
        ends = pretokens.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        out = each[ends[1:]] - each[ends[:-1]]
        out[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)] = 0  # no dummy prefix there
        for i in np.flatnonzero(odd):
            out[i] = len(self.sp.encode(texts[int(i)].as_py()))
        return out


def token_counts(docs: DataFrame, model: str | None = None, *, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    session(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    path = model or tokenizer_path("piece_bpe_32k.model")

    def count(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        shortcut = loaded(path)
        for b in slices(batches, "text", SLICE_BYTES):
            texts = b.column("text")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(shortcut.count(texts))],
                names=["doc_id", "n_bytes", "n_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


_LOADED: dict[str, Shortcut] = {}


def loaded(path: str) -> Shortcut:
    """One proven model a worker process."""
    if path not in _LOADED:
        _LOADED[path] = Shortcut(path)
    return _LOADED[path]


def plain_pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, for tests."""
    return re.findall(PRETOKEN, MARK + text.replace(" ", MARK)) if text else []
