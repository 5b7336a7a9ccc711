"""The walk-forward AR(2) forecast against least squares with numpy."""

import datetime as dt

import numpy as np
import pytest

from barsmith.operators.models import ar2_forecast


def _plain(x, t, min_obs):
    """The forecast of x[t] from x[:t], or None."""
    fit = [s for s in range(2, t) if None not in (x[s], x[s - 1], x[s - 2])]
    if len(fit) < min_obs or t < 2 or x[t - 1] is None or x[t - 2] is None:
        return None
    m = np.mean([x[s] for s in fit])
    a = np.array([[1.0, x[s - 1] - m, x[s - 2] - m] for s in fit])
    c = np.linalg.lstsq(a, np.array([x[s] - m for s in fit]), rcond=None)[0]
    return m + c @ [1.0, x[t - 1] - m, x[t - 2] - m]


@pytest.mark.parametrize("returns", [True, False])
def test_forecast_against_least_squares(spark, returns):
    rng, t0 = np.random.default_rng(3), dt.date(2020, 1, 1)
    # a level of a million with noise of a hundredth, a price near 50, a constant series
    series = {"hi": list(1e6 + 1e-2 * rng.standard_normal(150)), "lo": list(50 + rng.standard_normal(150).cumsum() * 0.3), "flat": [7.0] * 50}
    series = {k: [float(v) for v in vs] for k, vs in series.items()}
    for k in (0, 40, 41, 90):
        series["lo"][k] = None
    series["lo"][60] = 0.0
    rows = [(k, t0 + dt.timedelta(days=i), v) for k, vs in series.items() for i, v in enumerate(vs)]
    got = ar2_forecast(spark.createDataFrame(rows, "ticker string, date date, close double"), returns=returns, min_obs=10)
    found = {(r.ticker, r.date): r.ar2_forecast for r in got.collect()}
    assert len(found) == len(rows)
    for k, vs in series.items():
        x = [None, *[None if a is None or not b else a / b - 1 for a, b in zip(vs[1:], vs, strict=False)]] if returns else vs
        spread = np.std([v for v in x if v is not None])
        for t in range(len(vs)):
            want, f = (None if k == "flat" else _plain(x, t, 10)), found[k, t0 + dt.timedelta(days=t)]
            assert (f is None) == (want is None), (k, t, f, want)
            assert f is None or abs(f - want) <= 1e-5 * spread, (k, t, f, want)


def test_forecast_of_an_empty_table(spark):
    assert ar2_forecast(spark.createDataFrame([], "ticker string, date date, close double")).isEmpty()
