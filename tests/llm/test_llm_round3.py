"""Pair-index BPE, tokenizer alignment and whitening against the libraries
and plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barsmith.llm import alignment, bpe_pairs, whitening
from tests.conftest import SF01, SF001
from tests.llm.test_llm_arrow import ODD

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
sha = lambda x: hashlib.sha256(x).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = [*ODD, "<|endoftext|><|endoftext|> x", "<|endo", "ftext|>", "a▁b", "'ll've'", "x\x1c'\x85re", "<unk><s></s>", "aaaa" * 9, "çà et là " * 4000]
    extra = spark.createDataFrame([(5000 + i, t, "en", "s", 0) for i, t in enumerate(odd)] + [(None, "x y", None, None, None), (5003, "  ", "en", "s", 0)], base.schema)
    return base.unionByName(extra).withColumn("n_tokens", F.lit("clash")).withColumn("slice", F.lit(1)).withColumn("x", F.lit(None).cast("string")).cache()


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


# ---- operator 12 -------------------------------------------------------------
@pytest.mark.parametrize("slice_bytes", [bpe_pairs.SLICE_BYTES, 700])
def test_pair_bpe_is_the_librarys(docs, slice_bytes):
    lib = Tokenizer.from_file(BYTE)
    want = []
    for i, t in rows_of(docs):
        ids = lib.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode())))
    got = bpe_pairs.encode_ids(docs, digest=True, slice_bytes=slice_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert not bpe_pairs.encode_ids(docs.limit(0), digest=True).count()


@pytest.mark.parametrize("specials", [True, False])
def test_pair_bpe_on_random_texts(specials):
    rng = random.Random(3)
    lib, own = Tokenizer.from_file(BYTE), bpe_pairs.codec(BYTE)
    lib.encode_special_tokens = not specials
    parts = [*" \n\t'  'srevlmdt aAbB12!?<|>éßñ漢字🎉́\x85\xa0　 \x1c\x1f ½²ªİſ", "<|endoftext|>", "'ll", "'re", "n't", "aaaa", "<|endo", "ftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(map(chr, range(i, i + 64))) for i in [*range(0, 0xD800, 64), *range(0xE000, 0x11000, 64), *range(0x1F000, 0x20000, 64)]]
    ids, ends = own.encode(pa.array(texts), specials=specials)
    for t, x, w in zip(texts, np.split(ids, ends[:-1]), lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert x.tolist() == w.ids, t
        assert own.decode(x) == t.encode()


def test_pair_bpe_decodes(docs):
    ids = bpe_pairs.encode_ids(docs)
    assert sorted(map(tuple, bpe_pairs.decode_ids(ids).collect()), key=repr) == sorted(rows_of(docs), key=repr)
    cut = ids.filter("doc_id = 5016").select("doc_id", F.substring("ids", 1, 4).alias("ids"))
    lib = Tokenizer.from_file(BYTE)
    first = np.frombuffer(cut.first().ids, dtype="<u4").tolist()
    assert bpe_pairs.decode_ids(cut).first().text == lib.decode(first, skip_special_tokens=False)


def test_one_merge_a_word():
    own = bpe_pairs.codec(BYTE)
    # plain merging: the lowest rank anywhere in the word first
    ranks = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(own.left, own.right, own.made, strict=True))}
    rng = random.Random(4)
    words = ["".join(rng.choice("abelnrst") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    raw = np.frombuffer("".join(words).encode(), dtype=np.uint8)
    ids, ends = own.merge(own.of_byte[raw], np.cumsum([len(w) for w in words]))
    for w, got in zip(words, np.split(ids, ends[:-1]), strict=True):
        s = own.of_byte[np.frombuffer(w.encode(), dtype=np.uint8)].tolist()
        while cands := [(*ranks[p], k) for k, p in enumerate(zip(s[:-1], s[1:], strict=True)) if p in ranks]:
            _, m, k = min(cands, key=lambda c: (c[0], c[2]))
            s[k:k + 2] = [m]
        assert got.tolist() == s


# ---- operator 13 -------------------------------------------------------------
def plain_alignment(texts):
    """(n_a, n_b, groups, links) of each text, by loops over the libraries' tokens."""
    lib, sp = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    lib.encode_special_tokens = True
    back = {c: b for b, c in enumerate(bpe_pairs.byte_chars())}
    out = []
    for t in texts:
        a, b = lib.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        a_bytes = [bytes(back[c] for c in lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + t).encode():
            out.append((0, 0, [], []))
            continue
        ends = [np.cumsum([len(x) for x in many]).tolist() for many in (a_bytes, b_bytes)]
        groups = []
        lo_a = lo_b = 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            hi_a, hi_b = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            groups.append((a[lo_a:hi_a], b[lo_b:hi_b]))
            lo_a, lo_b = hi_a, hi_b
        out.append((len(a), len(b), groups, [(i, j) for x, y in groups for i in x for j in y]))
    return out


def plain_rows(rows):
    found = plain_alignment([t for _, t in rows])
    holders = Counter(p for *_, links in found for p in set(links))
    best = {}
    for (a, _), n in holders.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(holders[p] == best[p[0]] for p in links), sum(holders[p] for p in links),
                    sha(text.encode()) if text else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("slice_bytes", "wide"), [(alignment.SLICE_BYTES, alignment.WIDE), (700, 2)])
def test_alignment(docs, monkeypatch, slice_bytes, wide):
    few = docs.filter("doc_id < 60 or doc_id >= 5000 or doc_id is null")
    got = alignment.linked_counts(few, slice_bytes=slice_bytes, encode_bytes=3 * slice_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_rows(rows_of(few))
    a, b = bpe_pairs.codec(BYTE), alignment.loaded(PIECE)
    texts = [" " + t for _, t in rows_of(few) if t]
    one = alignment.align(texts, a, b)
    monkeypatch.setattr(alignment, "WIDE", wide)
    two = alignment.align(texts, a, b)
    assert all((getattr(one, k) == getattr(two, k)).all() for k in ("pair_text", "pair_code", "pair_times"))


def test_alignment_of_nothing(spark, docs):
    assert not alignment.linked_counts(docs.limit(0)).count()
    none = spark.createDataFrame([(1, None), (2, ""), (3, "▁"), (3, "▁")], "doc_id int, text string")
    assert sorted(map(tuple, alignment.linked_counts(none).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3, 3)]


def test_groups_by_random_intervals():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(n - 1) < 0.4) + 1, n) for _ in range(2))
        group_a, group_b = alignment.groups_of(a, b)
        cuts = np.intersect1d(a, b)
        assert (group_a == np.searchsorted(cuts, a)).all() and (group_b == np.searchsorted(cuts, b)).all()


# ---- operator 11 -------------------------------------------------------------
def plain_whitening(rows, components=4):
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    kept = [(i, np.floor(256 * np.array(v, dtype=float)).astype(np.int64)) for i, v in kept if len(v) == d]
    fit = np.unique([x for _, x in kept], axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    share = e / (centred ** 2).sum() * n
    return n, {"deviation": [(i, int(((n * x - s) ** 2).sum())) for i, x in kept], "share": share,
               "whitened": sorted(((i, *(np.abs((x - s / n) @ u) / np.sqrt(e)).round(6)) for i, x in kept), key=repr)}


def test_whitening(spark, monkeypatch):
    base = spark.read.parquet(f"{SF01}/embeddings.parquet")
    first = base.first().embedding
    odd = [(9000, None, 1), (9001, [], 1), (9002, [None, *first[1:]], 1), (9003, [float("nan"), *first[1:]], 1), (9004, [float("-inf"), *first[1:]], 1),
           (9005, first[:-1], 1), (None, first, None), (9006, first, 1), (9006, first, 1)]
    rows = base.unionByName(spark.createDataFrame(odd, base.schema)).withColumn("x", F.lit("clash")).withColumn("n", F.lit("clash"))
    n, want = plain_whitening([(r.vec_id, r.embedding) for r in rows.collect()])
    monkeypatch.setattr(whitening, "SPLIT_ROWS", 100)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    got = whitening.whiten(rows.repartition(5)).collect()
    assert {r.n for r in got} == {n}
    assert sorted(((r.vec_id, r.deviation) for r in got if r.component == 1), key=repr) == sorted(want["deviation"], key=repr)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for k in range(4):
        assert {round(r.explained, 9) for r in got if r.component == k + 1} == {round(want["share"][k], 9)}
    long = lambda rows: sorted(rows, key=lambda r: (repr(r[0]), r[1]))
    mine = long((r.vec_id, r.component, abs(r.whitened)) for r in got)
    theirs = long((i, k + 1, v) for i, *values in want["whitened"] for k, v in enumerate(values))
    assert [r[:2] for r in mine] == [r[:2] for r in theirs]
    assert np.allclose([r[2] for r in mine], [r[2] for r in theirs], atol=2e-6)
    # either sign, but the same for all rows: equal vectors have equal values
    assert len({(r.component, r.whitened) for r in got if r.deviation == [x for x in got if x.vec_id == 9006][0].deviation}) == 4


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    rows = lambda *vs: spark.createDataFrame([(i, v) for i, v in enumerate(vs)], schema)
    assert not whitening.whiten(rows()).count()
    assert not whitening.whiten(rows([1.0, 2.0], [1.0, 2.0])).count()  # no variance
    got = whitening.whiten(rows([1.0, 2.0], [3.0, 2.0], [3.0, 2.0], None)).collect()  # one direction varies
    assert sorted((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9), r.explained) for r in got) == [(i, 1, 2, 512 ** 2, 1.0, 1.0) for i in range(3)]
