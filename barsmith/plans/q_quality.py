"""Queries: data quality (Q1-Q3, A3-A5), tickers and request vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from barsmith.operators import quality as QL
from barsmith.plans import sql as Q
from barsmith.plans.registry import R, query, rounded
from barsmith.sources.bars import build_bars, missing_columns
from barsmith.sources.captures import vector_is_valid, vector_problems
from barsmith.sources.store import scratch_path
from barsmith.sources.tables import read_table

# raw per-line price rows (one "bar" per lineitem): duplicates per date
RAW_SQL = """
  SELECT p.p_brand AS ticker, CAST(l.l_shipdate AS DATE) AS date,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS open, l.l_extendedprice / NULLIF(l.l_quantity, 0) AS high,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS low, l.l_extendedprice / NULLIF(l.l_quantity, 0) AS close,
         l.l_quantity - 25 AS volume
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""


def raw_price_rows(spark, sf_dir):
    """Un-aggregated price rows per brand and ship date (duplicates per date;
    ``volume`` = quantity - 25 so some rows are negative on purpose)."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey)
    price = F.try_divide("l_extendedprice", "l_quantity")
    return j.select(F.col("p_brand").alias("ticker"), F.to_date("l_shipdate").alias("date"),
                    price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
                    (F.col("l_quantity") - 25).alias("volume"))


COUNTS_SQL = """
  SELECT ticker, count(*) AS n_rows,
    count(*) FILTER (WHERE open IS NULL) AS null_open, count(*) FILTER (WHERE high IS NULL) AS null_high,
    count(*) FILTER (WHERE low IS NULL) AS null_low, count(*) FILTER (WHERE close IS NULL) AS null_close,
    count(*) FILTER (WHERE volume IS NULL) AS null_volume,
    count(*) FILTER (WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0) AS n_nonpositive_price,
    count(*) FILTER (WHERE high < low) AS n_high_lt_low,
    count(*) FILTER (WHERE volume < 0) AS n_negative_volume,
    count(*) - count(DISTINCT date) AS n_duplicate_dates
  FROM raw GROUP BY ticker"""


@query("dq_rule_counts", lambda: Q.cte(raw=RAW_SQL, c=COUNTS_SQL) + "SELECT * FROM c")
def q_dq_rule_counts(spark, sf_dir):
    return QL.rule_counts(raw_price_rows(spark, sf_dir))


@query("dq_duplicates", lambda: Q.cte(raw=RAW_SQL, c=COUNTS_SQL) + "SELECT ticker, n_duplicate_dates FROM c")
def q_dq_duplicates(spark, sf_dir):
    return QL.rule_counts(raw_price_rows(spark, sf_dir)).select("ticker", "n_duplicate_dates")


@query("dq_null_fraction", lambda: Q.cte(raw=RAW_SQL, c=COUNTS_SQL) + "SELECT ticker, " + ", ".join(
    R(f"null_{c} / n_rows", f"null_frac_{c}") for c in QL.REQUIRED) + ", " + R(
    "greatest(" + ", ".join(f"null_{c} / n_rows" for c in QL.REQUIRED) + ")", "max_null_frac") + " FROM c")
def q_dq_null_fraction(spark, sf_dir):
    return rounded(QL.null_fractions(QL.rule_counts(raw_price_rows(spark, sf_dir))))


def _validate_sql(src: str, min_rows: int = 100) -> str:
    def pct(x):
        return f"printf('%.1f', {x} * 100) || '%'"
    errs = [f"CASE WHEN n_rows < {min_rows} THEN ticker || ': only ' || n_rows || ' rows, need at least {min_rows}' END"]
    warns = []
    for c in QL.REQUIRED:
        fr = f"(null_{c} / n_rows)"
        errs.append(f"CASE WHEN {fr} > 0.05 THEN ticker || '.{c}: null fraction ' || {pct(fr)} || ' > 5%' END")
        warns.append(f"CASE WHEN {fr} <= 0.05 AND {fr} > 0 THEN ticker || '.{c}: ' || {pct(fr)} || ' nulls present' END")
    errs.append("CASE WHEN n_nonpositive_price > 0 THEN ticker || ': ' || n_nonpositive_price || ' rows with non-positive prices' END")
    errs.append("CASE WHEN n_high_lt_low > 0 THEN ticker || ': ' || n_high_lt_low || ' rows where High < Low' END")
    warns.append("CASE WHEN n_duplicate_dates > 0 THEN ticker || ': ' || n_duplicate_dates || ' duplicate timestamps in index' END")
    errs.append("CASE WHEN n_negative_volume > 0 THEN ticker || ': ' || n_negative_volume || ' rows with negative volume' END")
    e = "list_filter([" + ", ".join(errs) + "], lambda x: x IS NOT NULL)"
    w = "list_filter([" + ", ".join(warns) + "], lambda x: x IS NOT NULL)"
    return f"SELECT ticker, len({e}) = 0 AS valid, {e} AS errors, {w} AS warnings FROM {src}"


@query("dq_validate", lambda: Q.cte(raw=RAW_SQL, c=COUNTS_SQL) + _validate_sql("c"))
def q_dq_validate(spark, sf_dir):
    return QL.validate_ohlcv(raw_price_rows(spark, sf_dir))


@query("dq_validate_bars", lambda: Q.cte(raw=Q.BARS_D, c=COUNTS_SQL) + _validate_sql("c"))
def q_dq_validate_bars(spark, sf_dir):
    """Q1 on the daily bars (all rules pass)."""
    from barsmith.sources.bars import daily_bars
    return QL.validate_ohlcv(daily_bars(spark, sf_dir))


@query("dq_assert", lambda: Q.cte(raw=Q.BARS_D, c=COUNTS_SQL) + _validate_sql("c"))
def q_dq_assert(spark, sf_dir):
    """Q2: raises on invalid bars; returns the (valid) validation table."""
    from barsmith.sources.bars import daily_bars
    bars = daily_bars(spark, sf_dir)
    QL.assert_valid(bars)
    return QL.validate_ohlcv(bars)


def _observed_sql(name: str) -> str:
    sums = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in QL.OBSERVED)
    bad = " OR ".join([f"sum(null_{c}) > 0.05 * sum(n_rows)" for c in QL.REQUIRED] + [f"sum({c}) > 0" for c in QL.OBSERVED[-3:]])
    return f"SELECT '{name}' AS source, {sums}, NOT coalesce({bad}, false) AS published FROM {name}_c"


@query("dq_observed", lambda: Q.cte(raw=RAW_SQL, raw_c=COUNTS_SQL, bars=Q.BARS_D, bars_c=COUNTS_SQL.replace("FROM raw", "FROM bars")) +
       _observed_sql("bars") + " UNION ALL " + _observed_sql("raw"))
def q_dq_observed(spark, sf_dir):
    """Q1 / Q2 counted by the write: the daily bars are published, the raw rows
    with their negative volumes are refused."""
    from barsmith.sources.bars import daily_bars
    root, rows = scratch_path(spark, "observed"), []
    for name, df in (("bars", daily_bars(spark, sf_dir)), ("raw", raw_price_rows(spark, sf_dir))):
        counts, errors = QL.publish_checked(df, f"{root}-{name}", "load-1")
        rows.append((name, *[counts[c] for c in QL.OBSERVED], not errors))
    return spark.createDataFrame(rows, "source string, " + ", ".join(f"{c} long" for c in QL.OBSERVED) + ", published boolean")


@query("dq_schema", lambda: Q.cte(raw=RAW_SQL) + """
SELECT DISTINCT ticker, false AS valid,
       [ticker || ': missing required columns: [''volume'']'] AS errors, CAST([] AS VARCHAR[]) AS warnings
FROM raw""")
def q_dq_schema(spark, sf_dir):
    """U4: required - present columns (schema only) on a raw frame without
    ``volume``; the check short-circuits to one error per ticker."""
    return QL.validate_ohlcv(raw_price_rows(spark, sf_dir).drop("volume"))


# ---- C1 tickers -------------------------------------------------------------
TICKERS_SQL = """
  SELECT DISTINCT p_brand AS raw FROM part
  UNION SELECT DISTINCT c_mktsegment FROM customer
  UNION SELECT DISTINCT ' ' || lower(n_name) || ' ' FROM nation
  UNION SELECT DISTINCT r_name FROM region"""


def tickers_raw(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select(F.col("p_brand").alias("raw"))
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("raw"))
    nat = read_table(spark, sf_dir, "nation").select(
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("raw"))
    reg = read_table(spark, sf_dir, "region").select(F.col("r_name").alias("raw"))
    return part.union(cust).union(nat).union(reg).distinct()


@query("validate_ticker", lambda: Q.cte(t=TICKERS_SQL) + """
SELECT raw, upper(trim(raw)) AS ticker, coalesce(regexp_full_match(upper(trim(raw)), '[A-Z]{1,5}'), false) AS valid
FROM t""")
def q_validate_ticker(spark, sf_dir):
    t = tickers_raw(spark, sf_dir)
    return t.select("raw", QL.normalize_ticker(F.col("raw")).alias("ticker"),
                    QL.ticker_is_valid(F.col("raw")).alias("valid"))


# ---- R1 / R2 / Q3 vectors -----------------------------------------------------
VEC_N = 64      # components of an embedding


VEC_SQL = f"""
  SELECT vec_id, label,
    CASE WHEN vec_id % 7 = 0 THEN CAST(embedding[1:{VEC_N - 1}] AS DOUBLE[])
         WHEN vec_id % 11 = 0 THEN list_concat(CAST(embedding[1:4] AS DOUBLE[]), [CAST('nan' AS DOUBLE)],
                                               CAST(embedding[6:{VEC_N}] AS DOUBLE[]))
         ELSE CAST(embedding AS DOUBLE[]) END AS features
  FROM embeddings"""


def vectors(spark, sf_dir):
    """Request vectors: the whole ``embeddings``; every 7th id lacks its last
    value (wrong length), every 11th gets a NaN at index 4."""
    e = read_table(spark, sf_dir, "embeddings")
    emb = F.col("embedding").cast("array<double>")
    nan_vec = F.concat(F.slice(emb, 1, 4), F.array(F.lit(float("nan"))), F.slice(emb, 6, VEC_N - 5))
    v = (F.when(F.col("vec_id") % 7 == 0, F.slice(emb, 1, VEC_N - 1))
          .when(F.col("vec_id") % 11 == 0, nan_vec)
          .otherwise(emb))
    return e.select("vec_id", "label", v.alias("features"))


@query("validate_vector", lambda: Q.cte(v=VEC_SQL) + f"""
SELECT vec_id,
  len(features) = {VEC_N} AND len(list_filter(features, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AS valid,
  list_concat(CASE WHEN len(features) <> {VEC_N} THEN ['Expected {VEC_N} features, got ' || len(features)] ELSE [] END,
              CASE WHEN len(features) = {VEC_N} THEN list_filter(list_transform(range(len(features)),
                   lambda i: CASE WHEN features[i + 1] IS NULL OR isnan(features[i + 1]) OR isinf(features[i + 1])
                                  THEN 'Feature[' || i || '] is not finite' END), lambda s: s IS NOT NULL)
                   ELSE [] END) AS problems
FROM v""")
def q_validate_vector(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return v.select("vec_id", vector_is_valid(F.col("features"), VEC_N).alias("valid"),
                    vector_problems(F.col("features"), VEC_N).alias("problems"))


@query("validate_batch", lambda: Q.cte(v=VEC_SQL) + f"""
SELECT label, count(*) AS n_records, count(*) BETWEEN {QL.BATCH_MIN} AND {QL.BATCH_MAX} AS valid
FROM v GROUP BY label""")
def q_validate_batch(spark, sf_dir):
    """R2: one batch request per label; 1..500 records allowed."""
    b = vectors(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n_records"))
    return b.withColumn("valid", QL.batch_is_valid(F.col("n_records")))


@query("request_quarantine", lambda: Q.cte(v=VEC_SQL) + f"""
SELECT vec_id,
  CASE WHEN len(features) = {VEC_N} AND len(list_filter(features, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
       THEN 'accepted' ELSE 'quarantined' END AS status,
  CASE WHEN len(features) <> {VEC_N} THEN 'Expected {VEC_N} features, got ' || len(features)
       WHEN len(list_filter(features, lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0 THEN
         'Feature[' || (list_position(list_transform(features, lambda x: x IS NULL OR isnan(x) OR isinf(x)), true) - 1)
         || '] is not finite' END AS reason
FROM v""")
def q_request_quarantine(spark, sf_dir):
    """Q3: accepted vs quarantined vectors with the first reason."""
    v = vectors(spark, sf_dir)
    probs = vector_problems(F.col("features"), VEC_N)
    ok = vector_is_valid(F.col("features"), VEC_N)
    return v.select("vec_id", F.when(ok, "accepted").otherwise("quarantined").alias("status"),
                    F.try_element_at(probs, F.lit(1)).alias("reason"))
