"""Fixed values of the analysis. They determine the results, so change them knowingly."""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

SERIES = ["store_id", "item_id"]

# --- horizons -----------------------------------------------------------------
HORIZON = 28            # days forecast and held out
SEASON = 7              # length of the weekly season
BACKTEST_WINDOWS = 4    # rolling-origin windows of HORIZON days
UNCERTAINTY_DAYS = 365  # training days that feed the 28-day demand spread

# --- forecast rules, in tie-break order -----------------------------------------
RULES = ["zero_forecast", "last_value_naive", "weekly_seasonal_naive", "mean_7_days", "mean_28_days"]
ADAPTIVE = "adaptive_baseline"
BOOSTING = "hist_gradient_boosting"

# --- demand patterns: lowest zero-sales percentage of each class ----------------
PATTERN_FLOORS = [(80.0, "highly_intermittent"), (50.0, "intermittent"), (20.0, "mixed")]

# --- economics -------------------------------------------------------------------
HOLDING_COST = 1.0
SHORTAGE_COST = 5.0
CRITICAL_RATIO = SHORTAGE_COST / (SHORTAGE_COST + HOLDING_COST)
SERVICE_FACTOR = NormalDist().inv_cdf(CRITICAL_RATIO)
MINIMUM_COVERAGE = 0.40
PROCUREMENT_SHARE = 0.60

POINT_POLICY = "point_forecast_order"
NEWSVENDOR_POLICY = "newsvendor_adjusted_order"

# --- resource scenarios: (name, budget ratio, capacity ratio) --------------------
RESOURCE_SCENARIOS = [("tight", 0.65, 0.70), ("balanced", 0.80, 0.85), ("near_full", 0.95, 0.95)]

# --- demand scenarios: (name, z, probability) ------------------------------------
DEMAND_SCENARIOS = [
    ("very_low", -1.2816, 0.10),
    ("low", -0.5244, 0.20),
    ("central", 0.0, 0.40),
    ("high", 0.5244, 0.20),
    ("very_high", 1.2816, 0.10),
]

# --- allocation methods -----------------------------------------------------------
PROPORTIONAL = "proportional_heuristic"
SHORTFALL = "milp_optimised"
EXPECTED_COST = "stochastic_expected_cost_milp"
METHODS = [PROPORTIONAL, SHORTFALL, EXPECTED_COST]

# --- features of the pooled model ---------------------------------------------------
LAGS = [1, 7, 14, 28]
ROLLING = [7, 28]
KNOWN_FEATURES = [
    "sell_price", "price_available", "event_flag", "snap_active",
    "weekday_sin", "weekday_cos", "month_sin", "month_cos",
]
HISTORY_FEATURES = [
    "lag_1", "lag_7", "lag_14", "lag_28",
    "rolling_mean_7", "rolling_std_7", "rolling_zero_rate_7",
    "rolling_mean_28", "rolling_std_28", "rolling_zero_rate_28",
    "demand_trend_7_vs_28",
]
FEATURES = KNOWN_FEATURES + HISTORY_FEATURES

SNAP_STATES = ["AF", "AM", "AS", "EU", "MI"]


@dataclass(frozen=True)
class BoostingParams:
    """Settings of the pooled Poisson model."""

    rounds: int = 150
    learning_rate: float = 0.05
    max_leaves: int = 31
    max_depth: int = 6
    min_leaf_rows: int = 40
    l2: float = 1.0
    max_bins: int = 255
    checkpoint_every: int = 10


# --- labels and attributes of the reporting dimensions -----------------------------
MODEL_DIMENSION = [
    ("last_value_naive", "Last-value naïve", "Statistical baseline", 1),
    ("weekly_seasonal_naive", "Weekly seasonal naïve", "Statistical baseline", 2),
    ("adaptive_baseline", "Adaptive baseline", "Backtest-selected baseline", 3),
    ("hist_gradient_boosting", "Gradient-boosted trees", "Machine learning", 4),
]
STAND_IN = ("linear", "Linear stand-in", "Fixed blend of lags", 5)  # member added where it is published
POLICY_DIMENSION = [
    ("point_forecast_order", "Point-forecast order", 0, 1),
    ("newsvendor_adjusted_order", "Newsvendor-adjusted order", 1, 2),
]
SCENARIO_DIMENSION = [
    ("tight", "Tight", 0.65, 0.70, 1),
    ("balanced", "Balanced", 0.80, 0.85, 2),
    ("near_full", "Near full", 0.95, 0.95, 3),
]
METHOD_DIMENSION = [
    ("proportional_heuristic", "Proportional heuristic", "Heuristic", 1),
    ("milp_optimised", "Least weighted shortfall", "Priced selection", 2),
    ("stochastic_expected_cost_milp", "Least expected cost", "Priced selection over demand scenarios", 3),
]
