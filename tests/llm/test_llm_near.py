"""N-gram Jaccard join, embedding near-dedup, components and the pipeline
against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.llm import embedding_dedup, graph, line_dedup, ngram_jaccard, packing, quality_rules, toxicity
from tests.conftest import SF01, SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    """Union-find with the smallest member as name."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.parent[b] = a


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_components(rows):
    sets, by = {i: shingle_set(t) for i, t in rows}, defaultdict(set)
    for i, s in sets.items():
        for g in s:
            by[g].add(i)
    out = Sets()
    for i, s in sets.items():
        for j in set().union(*(by[g] for g in s)) if s else ():
            if j < i and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                out.join(i, j)
    return {i: (len(s), out.root(i)) for i, s in sets.items()}


def near_copies():
    """Sets of many sizes with copies at, above and below the threshold, a
    chain, and a line that all share."""
    rng, rows = random.Random(8), []
    for n in [4, 5, 6, 8, 9, 12, 13, 20, 33, 60, 129, 300, 700]:
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)] + "one line that all of these share".split()
        for edits in (0, 0, 1, 1, 2, max(1, n // 60), max(1, n // 30), n // 12, n // 6):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(words).upper() if edits == 1 else "\n".join(words))
        cut = base[:-max(1, n // 9)]
        rows += [" ".join(cut), " ".join(base + base[:2])]
    return list(enumerate(rows, start=10_000))


def test_jaccard_components(spark):
    extra = [*near_copies(), (1, None), (2, ""), (3, " \n"), (4, "short one"), (5, "Short ONE"), (6, "short one")]
    base = spark.read.parquet(f"{SF001}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    docs = base.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("set", F.lit("clash"))
    want = jaccard_components([(r.doc_id, r.text) for r in docs.collect()])
    assert len({c for _, c in want.values()}) < len(want) - 30
    got = ngram_jaccard.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(want)


def test_jaccard_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "TILE", 3)
    docs = spark.createDataFrame(near_copies(), "doc_id long, text string")
    want = jaccard_components([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.near_duplicates(docs).collect()} == want


def test_jaccard_nulls_and_repeats(spark):
    t = "a b c d e f g h"
    docs = spark.createDataFrame([(None, t), (7, t), (7, t), (7, "other words entirely in this one text"), (None, ""), (None, "quite alone here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(None, 4, 7), (7, 4, 7), (7, 4, 7), (7, 3, 7), (None, 0, None), (None, 1, None)], key=repr)
    kept = ngram_jaccard.keep_one(docs)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(7, t), (7, "other words entirely in this one text"), (None, ""), (None, "quite alone here")], key=repr)
    assert not ngram_jaccard.near_duplicates(docs.limit(0)).count() and not ngram_jaccard.keep_one(docs.limit(0)).count()


def test_bucket_keys_meet_for_every_link():
    """Any two sets at the threshold share a key, whatever differs."""
    rng = np.random.default_rng(2)
    for n in [4, 5, 7, 10, 16, 17, 31, 64, 65, 130, 500, 2000]:
        for _ in range(40):
            base = rng.integers(-2**63, 2**63 - 1, n)
            drop = rng.integers(0, n // 9 + 1)
            add = rng.integers(0, n // 5 + 1)
            other = np.concatenate([base[drop:], rng.integers(-2**63, 2**63 - 1, add)])
            shared = n - drop
            if 9 * shared < 4 * (n + len(other)):
                continue
            a, b = ngram_jaccard.bucket_keys(np.concatenate([np.sort(base), np.sort(other)]), np.array([n, len(other)]))
            assert len(np.intersect1d(a, b)) or drop == add == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    sets = Sets()
    for a, b in edges:
        sets.join(a, b) if a != b else None
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: sets.root(x) for x in sets.parent}
    assert not graph.components(spark.createDataFrame([], "a long, b long")).count()


def vectors():
    rng, rows, i = np.random.default_rng(1), [], 0
    for label in (0, 1):
        for _ in range(40):
            base = rng.normal(size=64)
            for noise in (0, 0, 0.05, 0.1, 0.12, 0.14, 0.2, 0.3):
                rows.append((i, (base * rng.uniform(0.5, 2) + noise * rng.normal(size=64)).tolist() if noise else base.tolist(), label))
                i += 1
    base = rng.normal(size=64)
    rows += [(i + k, (base + 0.05 * rng.normal(size=64)).tolist(), 2) for k in range(90)]
    one = [1.0] + [0.0] * 63
    return rows + [(9000, None, 0), (9001, [0.0] * 64, 0), (9002, [float("nan")] * 64, 0), (9003, [None] + [1.0] * 63, 0), (9004, one, None), (9005, one, None),
                   (9006, one, 5), (9007, one, 5), (9007, one, 5), (None, one, 5), (9008, [], 5), (9009, [1.0, 0.0], 5), (9010, [x * 1e200 for x in one], 5), (9011, [-x for x in one], 5)]


def links_of(rows):
    good, n, sets = defaultdict(list), defaultdict(int), Sets()
    for k, (i, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            good[label, len(v)].append((k, i, x / np.sqrt((x * x).sum())))
    for part in good.values():
        cos = np.stack([x for *_, x in part]) @ np.stack([x for *_, x in part]).T
        for a, b in zip(*np.nonzero(cos >= 0.98), strict=True):
            if a != b:
                n[part[a][0]] += 1
                sets.join(part[a][0], part[b][0])
    return n, sets


@pytest.mark.parametrize("tile", [512, 16])
def test_embedding_links(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit("clash"))
    n, sets = links_of(rows)
    got = embedding_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    found = {r.vec_id: r for r in got if r.vec_id is not None}
    links = {i: n[k] for k, (i, *_) in enumerate(rows) if i is not None}
    assert sum(r.n_links for r in found.values()) >= 0.9 * sum(links.values())
    assert all(found[i].n_links <= links[i] for i in links)
    members = defaultdict(set)
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            members[sets.root(k)].add(i)
    name = {i: min(m) for m in members.values() for i in m}
    assert sum(found[i].component_id != name[i] for i in name) <= 0.02 * len(name)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert found[9007].n_links == 4 and found[9004].n_links == 0 and found[9011].component_id == 9011
    assert not embedding_dedup.near_duplicates(df.limit(0)).count()


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = embedding_dedup.hadamard(x) / 4
    assert np.allclose(x @ x.T, y @ y.T)
    axes, loss = embedding_dedup.signed_axes(x, 1, 3)
    assert axes.shape == (5, 3) and (loss[:, 0] == 0).all() and (np.diff(loss, axis=1) >= 0).all()


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    good = {r.doc_id for r in quality_rules.judge(docs).filter("kept").collect()}
    left = docs.filter(F.col("doc_id").isin(*good))
    clean = {r.doc_id for r in toxicity.judge(left, labels).filter("score < 0.5").collect()}
    left = left.filter(F.col("doc_id").isin(*clean))
    texts = {r.doc_id: r.text for r in line_dedup.dedup(left).collect() if r["__n_removed"] < max(1, r["__n_lines"])}
    names = jaccard_components(sorted(texts.items()))
    stay = {i for i, (_, c) in names.items() if c == i}
    rows = corpus_pipeline.run(spark, SF01).collect()
    assert {r.doc_id for r in rows} == stay
    words = packing.loaded(packing.tokenizer_path("word_bpe_49k.json"))
    tokens = {i: len(words.library.encode(texts[i], add_special_tokens=False).ids) + 1 for i in stay}
    assert {r.doc_id: r.doc_tokens for r in rows} == tokens
    packed = defaultdict(int)
    for r in rows:
        packed[r.doc_id] += r.length
    assert packed == tokens


def test_stages_keep_columns_and_take_empty_tables(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", None, 0), (9002, "x y z", None, "s", 5)], docs.schema)
    for table in (docs.limit(0), docs.unionByName(extra)):
        left = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, SF001)
            assert left.columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, left, SF001).count()
