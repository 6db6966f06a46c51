"""Settings of the risk model. Values that results depend on are fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Reproducibility and split shares.
SPLIT_SEED = 42
SPLIT_SHARES = (0.70, 0.15, 0.15)

# Feature matrix columns, in order.
FEATURES = (
    "amt",
    "haversine_distance_km",
    "amt_to_user_avg_ratio",
    "amt_to_cat_median_ratio",
    "trans_velocity_1h",
    "trans_velocity_24h",
    "is_night_transaction",
    "hour",
    "day_of_week",
    "customer_age",
    "category_fraud_rate",
)

# The unsupervised detector must see neither the label encoding nor the weekday.
ANOMALY_FEATURES = tuple(f for f in FEATURES if f not in ("day_of_week", "category_fraud_rate"))

# Sectors with elevated chargeback rates.
RISKY_CATEGORIES = ("shopping_net", "misc_net", "shopping_pos")

# Score bands of an anomaly score, upper edges inclusive.
ANOMALY_BANDS = ((0.0, 25.0), (25.0, 50.0), (50.0, 75.0), (75.0, 100.0))
ANOMALY_CUTOFF = 65.0

# Probability cut-offs tried by the threshold sweeps.
SWEEP_9 = tuple(i / 10 for i in range(1, 10))
SWEEP_17 = tuple(i / 100 for i in range(10, 91, 5))
SWEEP_37 = tuple(0.05 + i * ((0.95 - 0.05) / 36) for i in range(36)) + (0.95,)
SCORE_SWEEP = tuple(range(10, 91, 5))

LEAKAGE_CORRELATION = 0.90
OVERFIT_GAP = 0.05


@dataclass(frozen=True)
class CostConfig:
    """Money per decision error (fixed default values)."""

    chargeback_fee: float = 20.0
    merchant_margin: float = 0.20
    customer_friction: float = 10.0
    operational_cost: float = 5.0


WITH_OPERATIONS = CostConfig()
WITHOUT_OPERATIONS = CostConfig(operational_cost=0.0)


@dataclass(frozen=True)
class FusionConfig:
    """Weights and tier bounds of one fusion preset; inputs of ``unit`` scale are 0-1."""

    config_id: str
    w_ml: float
    w_anomaly: float
    w_rules: float
    low_max: float
    medium_max: float
    cutoff: int = 35
    actions: tuple[str, str, str] = field(default=("", "", ""))


# The three fusion presets and their action texts.
UNIT_FUSION = FusionConfig(
    "unit", 0.60, 0.15, 0.25, 35.0, 70.0,
    actions=(
        "Approve Transaction (Frictionless Checkout)",
        "Challenge (Request 3D-Secure / OTP Verification)",
        "Decline / Block (Prevent Potential Chargeback)",
    ),
)
LIVE_ACTIONS = (
    "Approve Transaction (Frictionless Checkout)",
    "Step-Up Verification (3D-Secure OTP / Verification Required)",
    "Hold for Review / Decline (High Chargeback Probability)",
)
LIVE_FUSION = FusionConfig("live", 0.65, 0.20, 0.15, 35.0, 69.0, actions=LIVE_ACTIONS)
FROZEN_FUSION = FusionConfig("frozen", 0.50, 0.25, 0.25, 35.0, 69.0, cutoff=25, actions=LIVE_ACTIONS)

TIERS = ("LOW RISK", "MEDIUM RISK", "HIGH RISK")

# Weight sets of the calibration benchmark (name, ml, anomaly, behaviour).
BENCHMARK_WEIGHTS = (
    ("Config A (Heavy ML)", 0.80, 0.10, 0.10),
    ("Config B (Balanced)", 0.65, 0.20, 0.15),
    ("Config C (High Anom)", 0.55, 0.30, 0.15),
    ("Config D (High Rules)", 0.60, 0.15, 0.25),
    ("Config E (Equal Safety)", 0.50, 0.25, 0.25),
)


def simplex_weights() -> list[tuple[int, float, float, float]]:
    """Weight grid: ml 0.40..0.80 and anomaly 0.05..0.35 in 0.05 steps, rules >= 0.05."""
    grid = []
    for i in range(9):
        for j in range(7):
            ml, anomaly = 0.4 + i * 0.05, 0.05 + j * 0.05
            rules = 1.0 - (ml + anomaly)
            if rules >= 0.05:
                grid.append((len(grid), ml, anomaly, rules))
    return grid
