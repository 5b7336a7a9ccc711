"""What the n-gram Jaccard join writes and ships."""

import random

import numpy as np
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm import ngram_jaccard
from barsmith.session import bucketed


def test_no_more_bucket_keys_than_a_link_needs():
    """One key more than elements that may differ, in each of a set's bands."""
    rng = np.random.default_rng(5)
    for n, most in ((500, (500 + 512) // 9 + (500 + 625) // 9 + 2), (1000, (1000 + 1024) // 9 + (1000 + 1250) // 9 + 2), (700, (700 + 875) // 9 + 1)):
        (keys,) = ngram_jaccard.bucket_keys(np.sort(rng.integers(-2**63, 2**63 - 1, n)), np.array([n]))
        assert n // 9 < len(keys) <= most


def test_bucket_keys_are_not_written(spark, tmp_path, monkeypatch):
    """Texts without near copies leave a short row each, and no set."""
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(1000))) for i in range(400)]
    rows += [(400, None), (401, ""), (0, rows[0][1]), (0, rows[0][1])]
    monkeypatch.setattr(session, "checkpoint_dir", lambda _: str(tmp_path))
    got = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, 996 if t else 0, i) for i, t in rows)
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 400_000


def test_bucketed_is_not_shuffled_again(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(spark.range(100).withColumn("x", F.col("id") * 2), "id", 8, "some-rows") as t:
            joined = spark.range(0, 300, 3).withColumnRenamed("id", "a").join(t.select(F.col("id").alias("a"), "x"), "a")
            assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
            assert sorted(tuple(r) for r in joined.collect()) == [(i, 2 * i) for i in range(0, 100, 3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("some_rows")]
