"""Split-conformal bands against sorted residuals, and their coverage."""

import math

import numpy as np
import pytest

from barsmith.operators import intervals as I

COLS = "k string, target double, prediction double"


def _offsets(spark, rows, by=("k",), **kw):
    df = spark.createDataFrame(rows, COLS).repartition(4)
    return {tuple(r[c] for c in by): tuple(r)[len(by):] for r in I.conformal_offsets(df, by, **kw).collect()}


def test_ranks_equal_sorted_residuals(spark):
    rng = np.random.default_rng(1)
    sizes = {"hot": 2000, "ties": 300, "nine": 9, "eight": 8, "one": 1}
    rows, res = [], {}
    for k, n in sizes.items():
        y = np.round(rng.normal(size=n), 1 if k == "ties" else 6)
        res[k] = np.sort(y - 0.25)
        rows += [(k, float(v), 0.25) for v in y]
    got = _offsets(spark, [*rows, ("hot", None, 0.25), ("hot", 1.0, None), ("null", None, 0.25)])
    assert set(got) == {(k,) for k in sizes}
    for k, n in sizes.items():
        lo, hi = (n + 1) * 100 // 1000, -(-(n + 1) * 900 // 1000)
        want = (n, res[k][lo - 1] if lo else None, res[k][hi - 1] if hi <= n else None)
        assert got[(k,)] == pytest.approx(want, abs=1e-12), k
    assert got[("eight",)][1] is None and got[("nine",)][1] is not None     # 9 rows are the fewest for p10


def test_ranks_are_not_shifted_by_rounding(spark):
    for n in (69, 109, 219, 999):
        got = _offsets(spark, [("a", float(v), 0.0) for v in range(1, n + 1)], low=300, high=700)
        assert got[("a",)] == (n, math.floor((n + 1) * 3 / 10), -(-(n + 1) * 7 // 10))


def test_empty_tables_and_no_keys(spark):
    assert _offsets(spark, []) == {}
    assert _offsets(spark, [], by=()) == {(): (0, None, None)}
    assert _offsets(spark, [("a", float(v), 0.0) for v in range(1, 20)], by=()) == {(): (19, 2.0, 18.0)}
    with pytest.raises(ValueError):
        I.conformal_offsets(spark.createDataFrame([], COLS), low=900, high=100)


def test_band_covers_fresh_rows(spark):
    """A skewed error and a model that is off: the share inside stays near 0.8."""
    rng = np.random.default_rng(3)
    draw = lambda n: [("a", float(v), 5.0) for v in rng.exponential(2.0, n)]
    off = I.conformal_offsets(spark.createDataFrame(draw(1500), COLS), ["k"]).first()
    test = spark.createDataFrame([(*r, r[2] + off.lower_offset, r[2] + off.upper_offset) for r in draw(4000)] + [("a", None, 5.0, 0.0, 1.0), ("b", 3.0, 5.0, None, None)],
                                 COLS + ", lower_bound double, upper_bound double")
    got = {r.k: (r.n_rows, r.coverage) for r in I.coverage(test, ["k"]).collect()}
    assert got["a"][0] == 4000 and abs(got["a"][1] - 0.8) < 0.03 and got["b"] == (1, 1.0)
