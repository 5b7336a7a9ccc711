"""Registered queries vs their DuckDB oracle on the smallest data set, and
the driver contract (entry / queries / oracle_sql)."""

import duckdb
import pytest

from barsmith.plans.registry import all_oracles, all_queries
from barsmith.sources.tables import TABLES
from tests.conftest import SF001

# fast, representative keys (the full list runs through tools/oracle_check.py)
KEYS = ["bars_build", "ind_rsi", "ind_macd", "feature_matrix", "baseline_stats", "drift_features",
        "drift_check", "capture_parse", "dq_validate", "validate_vector", "latency_buckets",
        "job_next_action", "retrain_events", "backtest_prices", "fold_summary", "stream_drift_window",
        "stream_last_n"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(rows, cols):
    import sys
    import os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import rows_of
    return rows_of(cols, rows)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = all_queries()[key](spark, SF001)
    got = _norm(df.collect(), df.columns)
    res = con.execute(all_oracles()[key])
    exp = _norm(res.fetchall(), [d[0] for d in res.description])
    assert got[1] == exp[1]
    assert got[0] == exp[0]


def test_driver_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "rsi_14" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100
