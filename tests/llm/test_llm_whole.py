"""Nothing is lost by a bound: samples that stand for their class."""

import random

import numpy as np
from pyspark.sql import functions as F

from barsmith.llm import toxicity


def labelled(spark, n0, n1):
    rng = random.Random(5)
    rows = []
    for i in range(n0 + n1):
        words = [f"word{rng.randrange(400)}" for _ in range(30)]
        rows.append((i, " ".join([*words, "vilestuff", "nastything"] if i < n1 else words), int(i < n1)))
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return both.select("doc_id", "text"), both.select("doc_id", "toxic")


def test_toxicity_follows_the_labels_mix(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 100)
    docs, labels = labelled(spark, 800, 100)
    _, stands_for = toxicity.labelled_sample(docs, labels, F.lit(True), "doc_id", "text")
    assert stands_for == {0: 8.0, 1: 1.0}
    assert abs(toxicity.fit(docs, labels).share - 1 / 9) < 1e-9


def test_toxicity_cut_and_strings_do_not_move_with_the_cap(spark):
    rng = np.random.default_rng(3)
    y = np.repeat([0.0, 1.0], [80_000, 10_000])
    x = np.stack([np.ones(len(y)), rng.normal(size=len(y)) + 2 * y], axis=1)
    capped = np.append(np.arange(5000), np.arange(80_000, 85_000))
    weight = np.where(y[capped] == 1, 2.0, 16.0)
    whole, part = toxicity._logistic(x, y, np.ones(len(y))), toxicity._logistic(x[capped], y[capped], weight)
    assert np.abs(whole - part).max() < 0.2
    assert abs(toxicity._best_cut(x @ whole, y, np.ones(len(y))) - toxicity._best_cut(x[capped] @ part, y[capped], weight)) < 0.4
    counts = spark.createDataFrame([(0, 7)], "k0 long, k1 long")
    natural, even = (toxicity._surplus(F.col("k1"), toxicity._expected(F.col("k0"), F.col("k1"), 1 / 8, rate)) for rate in (1.0, 8.0))
    a, b = counts.select(natural, even).first()
    assert abs(a - b) < 1e-9 and a > toxicity.SURPLUS


def test_toxicity_sample_is_bounded_by_rows(spark):
    docs, labels = labelled(spark, 20, 20)
    again = spark.range(200).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("other text "), "id").alias("text"))
    sample, _ = toxicity.labelled_sample(docs.unionByName(again), labels, F.lit(True), "doc_id", "text")
    assert sample.count() == 40
