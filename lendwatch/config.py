"""Parameters shared by the feature, validation and scoring steps."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EwConfig:
    """One object for features and training, so both use the same horizon."""

    horizon_months: int = 6
    target_min_pp: float = 0.005
    target_min_relative: float = 0.15
    min_portfolio: float = 10_000_000
    n_test_months: int = 6

    band_quantiles: tuple[float, float] = (0.7, 0.9)
    top_sectors: int = 8

    freshness_warn_days: int = 60
    freshness_error_days: int = 90

    gbt_iterations: int = 300
    gbt_depth: int = 4
    gbt_rate: float = 0.05
    gbt_min_leaf: int = 50
    # Early stopping holds out one row in ``gbt_hold_out``, at every size of the training data.
    gbt_early_stop: bool = True
    gbt_hold_out: int = 10
    gbt_stop_tolerance: float = 1e-7
    importance_repeats: int = 5
    seed: int = 42
    model_version: str = "ew-v1"


# The model's input columns, in their published order.
FEATURES = [
    "default_rate",
    "early_delinquency_rate",
    "default_rate_chg_3m",
    "default_rate_chg_6m",
    "early_delinquency_chg_3m",
    "portfolio_growth_6m",
    "avg_balance_per_operation",
    "log_active_portfolio",
    "selic_rate",
    "selic_chg_6m",
]
TARGET = "target_deterioration"
SEGMENT_KEYS = ["state", "credit_modality", "client_type", "client_size"]
