"""Finite-sample KS p-values against counted lattice paths."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsmith.functions.ksdist import exact_p
from barsmith.operators import drift as D
from barsmith.params import DriftParams


def counted(h: int, m: int, n: int) -> float:
    """Share of all paths to (m, n) with a point where |i n - j m| >= h, in integers."""
    ways = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m + 1):
        for j in range(n + 1):
            if abs(i * n - j * m) < h:
                ways[i][j] = 1 if i == j == 0 else (ways[i - 1][j] if i else 0) + (ways[i][j - 1] if j else 0)
    return float(1 - Fraction(ways[m][n], math.comb(m + n, m)))


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60), st.integers(1, 60), st.data())
def test_exact_p_counts_paths(m, n, data):
    g = math.gcd(m, n)
    h = data.draw(st.integers(0, m * n // g)) * g
    assert exact_p(h / (m * n), m, n) == pytest.approx(counted(h, m, n), rel=1e-11)


def test_exact_p_edges():
    assert exact_p(0.0, 5, 7) == 1.0
    assert exact_p(1.0, 3, 4) == pytest.approx(2 / math.comb(7, 3), rel=1e-12)
    assert exact_p(1.5, 3, 4) == 0.0
    assert math.isnan(exact_p(0.5, 0, 4)) and math.isnan(exact_p(float("nan"), 3, 4))
    assert 0 < exact_p(0.1, 10_000, 9_999) < 1e-40        # no cancellation in the tail


def test_pvalue_column_takes_the_branch_of_its_size(spark):
    rows = [("small", 0.25, 40, 60), ("limit", 0.25, 60, 60), ("large", 0.25, 61, 40), ("none", None, 40, 40)]
    df = spark.createDataFrame(rows, "k string, d double, n long, m long")
    got = {r.k: r.p for r in df.select("k", D.ks_pvalue(F.col("d"), F.col("n"), F.col("m"), DriftParams(ks_exact_max=60)).alias("p")).collect()}
    assert got["small"] == pytest.approx(counted(600, 40, 60), rel=1e-11)
    assert got["limit"] == pytest.approx(counted(900, 60, 60), rel=1e-11)
    en = 61 * 40 / 101
    lam = (math.sqrt(en) + 0.12 + 0.11 / math.sqrt(en)) * 0.25
    assert got["large"] == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101)), rel=1e-12)
    assert got["none"] is None or math.isnan(got["none"])


def test_raw_samples_get_the_exact_p(spark):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(0, 1, 48), 1), np.round(rng.normal(0.6, 1, 36), 1)
    rows = [("x", "a", float(v)) for v in a] + [("x", "b", float(v)) for v in b]
    got = D.ks_two_sample(spark.createDataFrame(rows, "feature string, sample string, value double"), ["feature"]).first()
    points = np.union1d(a, b)
    h = int(max(abs(int((a <= v).sum()) * 36 - int((b <= v).sum()) * 48) for v in points))
    assert got.ks_statistic == pytest.approx(h / (48 * 36), abs=1e-12)
    assert got.ks_p_value == pytest.approx(counted(h, 36, 48), rel=1e-11)
    assert got.ks_drifted == (got.ks_p_value < 0.05)
