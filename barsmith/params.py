"""Frozen parameter sets (the reference keeps these in YAML)."""

from __future__ import annotations

import math
from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureParams:
    # Fixed values that must equal the reference's defaults
    # (feature config): RSI period 14; SMA windows 5, 10, 20, 50;
    # EMA spans 12, 26; MACD signal span 9; Bollinger window 20 with 2
    # standard deviations; volume SMA window 20; lag periods 1..8;
    # target horizon 1; at least 150 rows after dropping incomplete rows.
    rsi_period: int = 14
    sma_windows: tuple[int, ...] = (5, 10, 20, 50)
    ema_spans: tuple[int, ...] = (12, 26)
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    bb_window: int = 20
    bb_std: float = 2.0
    volume_window: int = 20
    lag_periods: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7, 8)
    target_horizon: int = 1
    target_mode: str = "regression"          # or "classification"
    min_rows: int = 150
    min_rows_mode: str = "drop"              # "drop" (HAVING) or "fail"
    returns_long: int = 5

    def feature_names(self) -> list[str]:
        """Canonical ordered list of the feature columns (30 by default)."""
        names = [f"rsi_{self.rsi_period}"]
        names += [f"sma_{w}" for w in self.sma_windows]
        names += [f"ema_{s}" for s in self.ema_spans]
        names += ["macd_line", "macd_signal", "macd_hist"]
        names += ["bb_upper", "bb_lower", "bb_width", "bb_pct_b"]
        names += [f"volume_sma_{self.volume_window}", "volume_ratio", "obv", "vwap_dev"]
        names += ["returns_1d", f"returns_{self.returns_long}d", "hl_range", "gap"]
        names += [f"lag_ret_{p}" for p in self.lag_periods]
        return names

    # --- look-back / look-ahead needed by the blocked layout ------------
    def ewm_alphas(self) -> list[float]:
        al = [2.0 / (s + 1) for s in self.ema_spans]
        al += [2.0 / (self.macd_fast + 1), 2.0 / (self.macd_slow + 1),
               2.0 / (self.macd_signal + 1), 1.0 / self.rsi_period]
        return al

    def rolling_lookback(self) -> int:
        return max(
            max(self.sma_windows) - 1,
            self.bb_window - 1,
            self.volume_window - 1,
            self.returns_long,
            max(self.lag_periods) + 1,
        )


# EWM truncation: rows older than R contribute with relative weight
# (1-a)^R < EWM_TOL, far below double precision (1.1e-16).
EWM_TOL = 1e-20


def ewm_horizon(alpha: float, tol: float = EWM_TOL) -> int:
    """Rows of history after which an EWM weight falls below ``tol``."""
    q = 1.0 - alpha
    if q <= 0.0:
        return 1
    return int(math.ceil(math.log(tol) / math.log(q))) + 1


@dataclass(frozen=True)
class DriftParams:
    # Fixed values that must equal the reference's drift settings:
    # KS significance 0.05; PSI with 10 quantile bins; PSI clip 1e-6;
    # severity bands stable < 0.1 <= investigate < 0.2 <= severe;
    # overall drift when the drifted fraction >= 0.30; retrain when
    # max PSI >= 0.2 or overall drift; fewer than 10 live values -> no test;
    # fewer than 50 captured vectors -> no report; 20 histogram bins; exact
    # KS p-value where both samples have at most 10000 values.
    ks_alpha: float = 0.05
    ks_exact_max: int = 10_000
    psi_bins: int = 10
    psi_clip: float = 1e-6
    psi_stable: float = 0.1
    psi_investigate: float = 0.2
    drift_fraction_threshold: float = 0.30
    min_feature_samples: int = 10
    min_samples: int = 50
    hist_bins: int = 20
    lookback_days: int = 7


@dataclass(frozen=True)
class SplitParams:
    # Hold out the last 10 %; validation is 12.5 % of the
    # rest (index = int(test_idx * 0.875)); 3 walk-forward folds, gap 5.
    test_size: float = 0.10
    val_fraction: float = 0.875
    n_splits: int = 3
    gap: int = 5
    unit: str = "rows"            # "rows" (parity) or "dates" (leak-safe)


@dataclass(frozen=True)
class ModelParams:
    # Fixed values that must equal the reference's model settings: 500
    # boosting rounds, early stopping after 30 rounds without a better
    # validation RMSE; 50 search trials.
    n_estimators: int = 500
    early_stopping_rounds: int = 30
    n_trials: int = 50


DEFAULT_FEATURES = FeatureParams()
DEFAULT_DRIFT = DriftParams()
DEFAULT_SPLITS = SplitParams()
DEFAULT_MODELS = ModelParams()
