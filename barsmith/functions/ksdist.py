"""Finite-sample distribution of the two-sample Kolmogorov-Smirnov statistic.

Under the null every order of the pooled values is equally likely: a lattice
path from (0, 0) to (m, n), one step a value.  D >= d means that the path
touches a point (i, j) with |i n - j m| >= d n m.  Paths that have stayed
inside are counted row by row (a row is the running sum of the row before), and
the chance of every first step outside is added up, so that small p-values do
not come from a difference.
"""

from __future__ import annotations

import numpy as np

_RESCALE = 1e200


def exact_p(d: float, n_a: int, n_b: int) -> float:
    """P(D >= d) for samples of ``n_a`` and ``n_b`` values; NaN without values.

    Work: min(n_a, n_b) vector operations over the band's width."""
    m, n = sorted((int(n_a), int(n_b)))
    if m < 1 or not np.isfinite(d):
        return float("nan")
    h = round(d * m * n)             # the statistic is a multiple of 1 / (m n)
    if h <= 0:
        return 1.0
    if h > m * n:
        return 0.0
    log_fact = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, m + n + 1)))))
    log_all = log_fact[m + n] - log_fact[m] - log_fact[n]

    def mass(count, log_scale, i, j):
        """Chance of paths that come to (i, j), ``count`` ways, and go on anyhow."""
        with np.errstate(divide="ignore"):
            logs = np.log(count) + log_scale + log_fact[m + n - i - j] - log_fact[m - i] - log_fact[n - j] - log_all
        return float(np.exp(np.minimum(logs, 0.0)).sum())

    out, log_scale = 0.0, 0.0
    lo, hi = 0, min(n, -(-h // m) - 1)
    row = np.ones(hi + 1)            # row[k]: ways to (i, lo + k) inside the band
    for i in range(m + 1):
        if i:
            new_lo = max(0, (i * n - h) // m + 1)
            new_hi = min(n, -(-(i * n + h) // m) - 1)
            if new_hi < new_lo:          # no point of this row is inside
                return 1.0
            gone = row[: max(0, new_lo - lo)]
            if gone.size:
                out += mass(gone, log_scale, i, lo + np.arange(gone.size))
            kept = row[gone.size:]
            row = np.zeros(new_hi - new_lo + 1)
            row[: kept.size] = kept
            np.cumsum(row, out=row)
            lo, hi = new_lo, new_hi
            if row[-1] > _RESCALE:
                log_scale += np.log(row[-1])
                row /= row[-1]
        if hi < n:
            out += mass(row[-1:], log_scale, i, np.array([hi + 1]))
    return min(out, 1.0)
