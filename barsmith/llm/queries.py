"""Registered queries of the training-data operators and their DuckDB SQL.

Every query applies its operator, with the default parameters, to the whole
table it names.  Queries without SQL are tested against brute force in
``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import alignment, bpe_pairs, byte_bpe, embedding_dedup, line_dedup, ngram_jaccard, oracles, packing, quality_rules, shuffle_shard, token_counts, toxicity, url_filter, whitening
from barsmith.sources.tables import read_table

# The rules of the URL query, (verdict, host and path).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the canonical forms of the URLs that block rules fit, so
    another spelling of a blocked page, which no rule fits, is blocked too."""
    pages = read_table(spark, sf_dir, "pages")
    listed = url_filter.judge(pages, URL_RULES).filter(F.col("verdict") == "block").select("canonical")
    return url_filter.judge(pages, URL_RULES, listed).select("page_id", "host", "path", "rule", "verdict")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", "kept")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shuffle_shard.shard(read_table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.roundtrip(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a word, how many of them are removed, and the text left."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup(docs)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=4)


def op12_bpe_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_pairs.encode_ids(read_table(spark, sf_dir, "documents"), digest=True)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.linked_counts(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_token_counts, op3_quality_rules, op4_packing, op5_ngram_jaccard, op6_embedding_dedup, op7_sharding,
        op8_toxicity, op9_byte_bpe, op10_line_dedup, op11_whitening, op12_bpe_pairs, op13_alignment)
}

ORACLES: dict[str, str] = {
    "op1_url_filter": oracles.url_filter(URL_RULES),
    "op3_quality_rules": oracles.quality_rules(quality_rules.STEPS),
    "op5_ngram_jaccard": oracles.ngram_jaccard(),
    "op6_embedding_dedup": oracles.embedding_dedup(),
    "op10_line_dedup": oracles.line_dedup(),
}
