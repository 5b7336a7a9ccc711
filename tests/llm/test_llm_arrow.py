"""Token counts, packing, sharding, byte-level BPE and toxicity against the
libraries and plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers as P
from pyspark.sql import functions as F

from barsmith.llm import byte_bpe, packing, shuffle_shard, token_counts, toxicity
from tests.conftest import SF01, SF001

ODD = [None, "", " ", "  ", "a  b", " lead", "trail ", "\n", "a\nb\n\n c", "x▁y ▁", "tab\tand\x01sep", "<s> </s> <0x0A> <unk>", "Don't I'll '", "<|endoftext|>x", "İΣς ſ K",
       "🎉🎉 e\u0301 漢字かな", "z" * 3000, ("word " * 3000).strip(), "a_b 12½ ªº² ³", "\x00\x85 \u3000x"]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = spark.createDataFrame([(5000 + i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(None, "x y", None, None, None), (5003, "  ", "en", "s", 0)], base.schema)
    return base.unionByName(extra).withColumn("n_tokens", F.lit("clash")).cache()


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_token_counts(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = sorted(((i, len(t.encode()), n := len(sp.encode(t)), n > 4096) for i, t in rows_of(docs)), key=repr)
    got = token_counts.token_counts(docs)
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=repr) == want
    assert not token_counts.token_counts(docs.limit(0)).count()


def test_whole_tokens_are_proven():
    s = token_counts.loaded(P.path("piece_bpe_32k.model"))
    assert len(s.whole) > 25_000
    assert all(len(s.sp.encode(w[1:].replace("▁", " "))) == 1 for w in list(s.whole)[:3000] if w[:1] == "▁" and len(w) > 1)


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 11), (100, 40)])
def test_byte_bpe(docs, chunk, overlap):
    c = byte_bpe.codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    want = sorted(((i, len(ids := c.encode(t)), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows_of(docs)), key=repr)
    assert sorted(map(tuple, byte_bpe.roundtrip(docs, chunk=chunk, overlap=overlap).collect()), key=repr) == want


def test_byte_bpe_decodes(docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode_ids(docs, path, P.PATTERN)
    assert sorted(((r.doc_id, bytes(r.bytes).decode()) for r in byte_bpe.decode_ids(ids, path, P.PATTERN).collect()), key=repr) == sorted(rows_of(docs), key=repr)


def test_packing(docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = rows_of(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]))
    ids = {i: np.array([*lib.encode(t, add_special_tokens=False).ids, 2], dtype="<u4") for i, t in texts}
    pieces = packing.pack(docs.filter("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            part = ids[i][at:at + p.length]
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids[i]), zlib.crc32(part.tobytes()))
            at += p.length
        assert at == len(ids[i])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    assert not packing.pack(docs.limit(0)).count()


def test_packing_pads_little(spark):
    p = packing.pack(spark.read.parquet(f"{SF01}/documents.parquet").coalesce(1))
    n = [r.n for r in p.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert sum(4096 - x for x in n if x & (x - 1)) < 0.03 * sum(n)


def test_word_ids_are_the_librarys():
    import pyarrow as pa

    w = packing.loaded(P.path("word_bpe_49k.json"))
    texts = [" ".join(f"a{chr(k)}b{chr(k)}{chr(k)}1" for k in range(a, a + 16)) for a in range(0, 0x2100, 16)] + [t for t in ODD if t]
    assert [x.tolist() for x in w.of_texts(pa.array(texts))] == [w.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert w.whole("Some words. " * 20_000).tolist() == w.library.encode("Some words. " * 20_000, add_special_tokens=False).ids


def test_plan_is_optimal():
    rng = np.random.default_rng(5)
    for _ in range(30):
        cuts = np.append(0, np.cumsum(rng.integers(1, 12, 25)))
        costs = np.append(0, rng.integers(0, 5, 25)).astype(float)
        best = [0.0] + [np.inf] * 25
        pad = lambda n: 0 if n in (16, 8, 4, 2) else 16 - n
        for j in range(1, 26):
            best[j] = min(best[i] + pad(cuts[j] - cuts[i]) + costs[j] for i in range(j) if cuts[j] - cuts[i] <= 16)
        ends = packing.plan(cuts, costs, 16)
        edges = [0, *ends]
        assert ends[-1] == 25
        assert sum(pad(cuts[b] - cuts[a]) + costs[b] for a, b in zip(edges[:-1], edges[1:], strict=True)) == best[25]


def test_sharding(spark, docs):
    out = shuffle_shard.shard(docs, 16).collect()
    texts = rows_of(docs)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in out), key=repr) == sorted(((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts), key=repr)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = shuffle_shard.shard(docs.repartition(7), 16).collect()
    key = lambda r: repr((r.row, r.doc_id, r["size"], r.text_crc32, r.shard, r.slot))
    assert sorted(map(key, again)) == sorted(map(key, out))
    assert all(shuffle_shard.place(r.row, len(out), 16) == (r.shard, r.slot) and shuffle_shard.row_at(r.shard, r.slot, len(out), 16) == r.row for r in out[:50])
    assert not shuffle_shard.shard(docs.limit(0)).count()


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 65_537])
def test_feistel_is_a_permutation(n):
    p = shuffle_shard.permute(np.arange(n), n)
    assert sorted(p.tolist()) == list(range(n))
    assert (shuffle_shard.permute(p, n, inverse=True) == np.arange(n)).all()


def test_copies_are_expanded_in_blocks(spark):
    from barsmith.llm.common import with_copies

    rows = with_copies(spark.createDataFrame([("a", 1), ("b", 25)], "k string, n long"), "n", direct=10).collect()
    assert sorted((r.k, r["_copy"]) for r in rows) == [("a", 0), *(("b", i) for i in range(25))]


def auc(score, y):
    s = np.sort(np.unique(score))
    below = np.searchsorted(np.sort(score[y == 0]), score[y == 1], side="left") + np.searchsorted(np.sort(score[y == 0]), score[y == 1], side="right")
    assert len(s) > 10
    return below.mean() / 2 / (y == 0).sum()


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.judge(docs, labels)
    rows = out.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").toPandas()
    y = rows.toxic.to_numpy()
    assert auc(rows.score.to_numpy(), y) > 0.93
    assert rows.predicted[y == 1].mean() > 0.7 and rows.predicted[y == 0].mean() < 0.05
    assert out.count() == docs.count()


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == docs.count() and {r.score for r in rows} <= {0.0, 1.0}
    some = spark.read.parquet(f"{SF01}/labels.parquet")
    kept = toxicity.keep(docs, some)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    assert not toxicity.judge(docs.limit(0), labels).count()


def test_toxic_features_are_plain_compression():
    import re

    import pyarrow as pa
    import zstandard as zstd

    runs = {" idiot ": 9, " stupi": 7, "scum ": 5, " réeux": 8}
    ordinary = toxicity._train([b"the quick brown fox and so on ", b"nothing to see here "], 512)
    model = toxicity.Model(ordinary, (toxicity._toxic_dictionary(runs), toxicity._toxic_dictionary({})), (), 0.0)
    texts = [t or "" for t in ODD] + ["You IDIOT, you scum! " * 40, "What a stupid, stupid day; réeuxpa...", "idiot"]
    got = toxicity.features(pa.array(texts), model.compressors())
    p = zstd.ZstdCompressionParameters(min_match=5, strategy=zstd.STRATEGY_GREEDY, window_log=16, hash_log=14, chain_log=14, search_log=4,
                                       write_content_size=False, write_checksum=False, write_dict_id=False)
    for text, row in zip(texts, got, strict=True):
        data = re.sub(toxicity.BLANK, " ", f" {text.lower()} ", flags=re.ASCII).encode() if text else b""
        begin, end, _ = toxicity.windows(np.frombuffer(data, dtype=np.uint8), np.array([0]), np.array([len(data)]))
        want = [len(begin)]
        for extra in model.toxic:
            size = [[len(zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(c + toxicity.LEAD, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=p)
                         .compress(toxicity.LEAD + data[i:j])) for i, j in zip(begin, end, strict=True)] for c in (ordinary, extra + ordinary)]
            saved = sorted((a - b for a, b in zip(*size, strict=True)), reverse=True)
            want += [*(saved + [0, 0])[:2], sum(max(x - 2, 0) for x in saved)]
        assert row.tolist() == want, text


def test_windows_cover_every_byte():
    for text in (b"", b"x", b"a " * 500, b"y" * 1000, b"one two\nthree " * 40):
        data = np.frombuffer(text, dtype=np.uint8)
        begin, end, owner = toxicity.windows(data, np.array([0]), np.array([len(data)]))
        assert b"".join(text[i:j] for i, j in zip(begin, end, strict=True)) == text
        assert (end - begin <= 2 * toxicity.WINDOW).all() and len(owner) == len(begin)
