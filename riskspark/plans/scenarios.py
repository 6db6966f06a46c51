"""Scenario regression: what a table would score if its transactions behaved like known cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = (
    "haversine_distance_km", "amt_to_user_avg_ratio", "amt_to_cat_median_ratio", "trans_velocity_1h", "trans_velocity_24h", "is_night_transaction",
)

# Scenario, expected tier, and the behaviour fields in the order above.
SCENARIOS = (
    ("legit_grocery", "LOW RISK", (3.8, 0.85, 0.95, 0, 1, 0)),
    ("velocity_burst", "HIGH RISK", (15.0, 4.20, 3.10, 4, 7, 0)),
    ("impossible_travel", "HIGH RISK", (1450.0, 7.50, 4.80, 1, 3, 0)),
    ("late_night_spike", "HIGH RISK", (820.0, 12.40, 6.50, 2, 4, 1)),
    ("travel_dining", "MEDIUM RISK", (280.0, 2.10, 2.40, 0, 2, 0)),
    ("preset_high", "HIGH RISK", (1450.0, 7.8, 4.5, 3, 5, 1)),
    ("preset_low", "LOW RISK", (3.2, 0.82, 0.91, 0, 1, 0)),
    ("preset_moderate", "MEDIUM RISK", (450.0, 2.8, 1.8, 1, 2, 1)),
)


# The known cases as whole requests, with their expected tiers.
RECORD_FIELDS = ("trans_num", "expected_tier", "amt", "category", "hour", "day_of_week", "customer_age", *FIELDS)
RECORDS = (
    ("TXN_LEGIT_001", "LOW RISK", 42.50, "grocery_pos", 14, 2, 36.0, 3.8, 0.85, 0.95, 0, 1, 0),
    ("TXN_BURST_002", "HIGH RISK", 280.00, "shopping_net", 22, 4, 29.0, 15.0, 4.20, 3.10, 4, 7, 0),
    ("TXN_TRAVEL_003", "HIGH RISK", 650.00, "shopping_pos", 18, 5, 45.0, 1450.0, 7.50, 4.80, 1, 3, 0),
    ("TXN_NIGHT_004", "HIGH RISK", 1750.00, "misc_net", 3, 1, 52.0, 820.0, 12.40, 6.50, 2, 4, 1),
    ("TXN_DINING_005", "MEDIUM RISK", 165.00, "food_dining", 20, 3, 38.0, 280.0, 2.10, 2.40, 0, 2, 0),
    ("TXN_FRAUD_7849", "HIGH RISK", 865.20, "shopping_net", 3, 5, 42.0, 1450.0, 7.8, 4.5, 3, 5, 1),
    ("TXN_GENUINE_1024", "LOW RISK", 38.50, "grocery_pos", 12, 1, 35.0, 3.2, 0.82, 0.91, 0, 1, 0),
    ("TXN_MODERATE_3041", "MEDIUM RISK", 220.0, "travel", 1, 6, 29.0, 450.0, 2.8, 1.8, 1, 2, 1),
)


def records(spark: SparkSession) -> DataFrame:
    """The known cases as requests."""
    kinds = ("string", "string", "double", "string", "int", "int", "double", "double", "double", "double", "int", "int", "int")
    return spark.createDataFrame(list(RECORDS), ", ".join(f"{n} {k}" for n, k in zip(RECORD_FIELDS, kinds)))


def with_scenarios(df: DataFrame) -> DataFrame:
    """Each row once per scenario: its own amount and category, the scenario's behaviour."""
    cases = F.array(*[
        F.struct(
            F.lit(name).alias("scenario"), F.lit(expected).alias("expected_tier"),
            *[F.lit(float(v)).alias(f) for f, v in zip(FIELDS, values)],
        ) for name, expected, values in SCENARIOS
    ])
    return df.drop(*FIELDS).select("*", F.inline(cases))
