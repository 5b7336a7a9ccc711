"""URL filter, quality rules and line dedup against plain Python versions."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barsmith.llm import bloom, line_dedup, quality_rules, url_filter
from barsmith.llm.queries import URL_RULES
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
URLS = [None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://x.www.example.com/en", "ftp://net/es/1",
        "http://a.net/fr/2#t", "http://a.net/fr", "http://net", "http://net?/es/", "://example.com/en/", "http://example.com/en/a://b.net/es/",
        "http://notnet/es/", "http://a.b.c.d.e.net/es/", "http://=com/x", "http://e.org/" + "y" * 5000, "http://a.net/fr/2.html"]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [(len(r), r, v) for v, r in URL_RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_rules(spark):
    urls = [(i, u, "x", "clash") for i, u in enumerate([*URLS, URLS[3], URLS[3]])] + [(None, URLS[4], "x", "c"), (3, URLS[3], "x", "c")]
    df = spark.createDataFrame(urls, "page_id long, url string, entry string, host string")
    got = sorted(url_filter.judge(df, URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect(), key=repr)
    assert [tuple(r) for r in got] == sorted([(i, *judged(u)) for i, u, *_ in urls], key=repr)
    assert not url_filter.judge(df.limit(0), URL_RULES).count()


def test_listed_urls_and_bloom(spark):
    pages = spark.createDataFrame([(1, "http://e.org/a/index.html"), (2, "https://E.org/a?x"), (3, "http://e.org/b"), (4, "http://a.com/a")], "page_id long, url string")
    listed = spark.createDataFrame([("e.org/a",), ("a.com/a",), (None,)], "canonical string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, URL_RULES, listed).collect()}
    assert got == {1: (None, "block"), 2: (None, "block"), 3: (None, "allow"), 4: ("com/", "allow")}  # a rule outranks the list
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    filt = bloom.build(keys.filter("k like '%0'"), "k", 256)
    hits = bloom.possible_hits(keys, "k", filt, 256)
    assert hits.filter("k like '%0'").count() == 300
    assert hits.count() < 400
    assert hits.count() + bloom.sure_misses(keys, "k", filt, 256).count() == 3000


TEXTS = [None, "", " \t\n\v", "one", "a b c a b c", "x " * 30 + "# < a", "Ä ö 🎉 | $\n\n l\nl\nl ", "a b\x0bc\u00a0d " * 200, "w " + "v " * 60,
         "The quick brown fox jumps over the lazy dog near the old river bank. " * 1]


def counted(t):
    w = WORD.findall(t or "")
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    many, cov = Counter(grams), set()
    for k, g in enumerate(grams):
        if many[g] > 1:
            cov |= {k, k + 1, k + 2}
    ln = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum((t or "").count(s) for s in "#*$%&|<>"), len(ln) - len(set(ln)), len(cov)


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(10_000 + i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + [(None, "some text here", "en", "s", 0), (10_001, "", "en", "s", 0)]
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    return base.unionByName(spark.createDataFrame(extra, base.schema)).withColumn("__vote", F.lit("clash")).cache()


def test_quality_counts_and_posterior(spark, docs):
    rows = quality_rules.judge(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(((i, *counted(t)) for i, t in texts), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=repr) == want
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and r.posterior >= 0.5)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert not quality_rules.judge(docs.limit(0)).count()


def test_estimate_is_plain_em(spark):
    import math
    import random

    random.seed(3)
    R = quality_rules.R
    votes = []
    for _ in range(400):
        good = random.random() < 0.8
        votes.append([random.choices([1, 0, -1], [0.8, 0.15, 0.05] if good else [0.3, 0.2, 0.5])[0] for _ in range(R)])
    df = spark.createDataFrame([(v,) for v in votes], "vote array<tinyint>")
    got = {tuple(r.vote): r.posterior for r in quality_rules.estimate(df).collect()}
    n = Counter(map(tuple, votes))
    q = {v: 1 / (1 + math.exp(4 * v.count(-1) - v.count(1))) for v in n}
    for step in range(quality_rules.STEPS + 1):
        pi = (sum(n[v] * q[v] for v in n) + 1) / (len(votes) + 2)
        p = []
        for weight in (q, {v: 1 - x for v, x in q.items()}):
            total = sum(n[v] * weight[v] for v in n)
            p.append([{s: (sum(n[v] * weight[v] for v in n if v[r] == s) + 1) / (total + 3) for s in (1, -1)} for r in range(R)])
        like = lambda c, v: sum(math.log(p[c][r][s] if s else 1 - p[c][r][1] - p[c][r][-1]) for r, s in enumerate(v))
        q = {v: 1 / (1 + math.exp(min(math.log(1 - pi) + like(1, v) - math.log(pi) - like(0, v), 500))) for v in n}
    assert all(abs(got[v] - q[v]) < 1e-6 for v in n)


def windows(lines):
    full = [(a.strip(" \t\n\x0b\x0c\r"), k) for k, a in enumerate(lines)]
    full = [x for x in full if x[0]]
    if len(full) >= 3:
        return [(tuple(y[0] for y in full[k:k + 3]), full[k][1], full[k + 2][1]) for k in range(len(full) - 2)]
    return [(tuple(y[0] for y in full), full[0][1], full[-1][1])] if full else []


def test_line_dedup(spark, docs):
    extra = [(20_000, "a\nb\nc\nd"), (20_001, "x\n a\n\nb \nc\ny"), (20_002, "b\nc\nd"), (20_003, "z\nz\nz\nz\nz"), (20_004, "only"), (20_005, "only"), (20_006, "b\nc")]
    both = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(i, t, "en") for i, t in extra], "doc_id long, text string, lang string"))
    rows = [(r.doc_id, r.text) for r in both.collect() if r.doc_id is not None and r.text]
    seen, want = set(), {}
    for i, t in sorted(rows):
        lines, cut = t.split("\n"), set()
        for w, a, b in windows(lines):
            if w in seen:
                cut |= set(range(a, b + 1))
            seen.add(w)
        want[i] = "\n".join(x for k, x in enumerate(lines) if k not in cut)
    out = line_dedup.dedup(both)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == both.count()
    assert {i: got[i].text for i in want} == want
    assert got[20_001].text == "x\ny" and got[20_001]["__n_removed"] == 3 and got[20_003].text == "z"
    kept = {r.doc_id for r in line_dedup.keep_lines(both).collect()}
    assert 20_005 not in kept and 20_004 in kept and 10_000 in kept  # emptied texts go, empty ones stay
    assert not line_dedup.dedup(both.limit(0)).count()


def test_repeated_rows_are_one_document(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in line_dedup.dedup(df).collect()) == [("1", ""), ("1", ""), ("None", "a\nb\nc")]
