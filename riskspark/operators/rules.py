"""Declarative rules compiled to Columns: a rule is a row of settings, not a loop over records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.config import RISKY_CATEGORIES
from riskspark.functions.numeric import clip, fixed, half_even

# What a missing input counts as.
NEUTRAL = {
    "amt": 0.0,
    "amt_to_user_avg_ratio": 1.0,
    "amt_to_cat_median_ratio": 1.0,
    "haversine_distance_km": 0.0,
    "trans_velocity_1h": 0.0,
    "trans_velocity_24h": 0.0,
    "is_night_transaction": 0.0,
}


class Inputs:
    """Rule inputs of a frame; absent columns and nulls take neutral values."""

    def __init__(self, df: DataFrame):
        self._have = set(df.columns)

    def _number(self, name: str) -> Column:
        neutral = F.lit(NEUTRAL[name])
        return F.coalesce(F.col(name).cast("double"), neutral) if name in self._have else neutral

    amt = property(lambda self: self._number("amt"))
    user_ratio = property(lambda self: self._number("amt_to_user_avg_ratio"))
    cat_ratio = property(lambda self: self._number("amt_to_cat_median_ratio"))
    distance = property(lambda self: self._number("haversine_distance_km"))
    v1h = property(lambda self: self._number("trans_velocity_1h"))
    v24h = property(lambda self: self._number("trans_velocity_24h"))
    night = property(lambda self: self._number("is_night_transaction").cast("int") == 1)

    @property
    def category(self) -> Column:
        return F.coalesce(F.lower("category"), F.lit("")) if "category" in self._have else F.lit("")

    @property
    def risky(self) -> Column:
        return self.category.isin(*RISKY_CATEGORIES)


def _full(_: Inputs) -> Column:
    return F.lit(1.0)


def _no_text(_: Inputs) -> Column:
    return F.lit("")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    weight: float
    fires: Callable[[Inputs], Column]
    description: str = ""
    severity: Callable[[Inputs], Column] = _full
    message: Callable[[Inputs], Column] = _no_text


# The five weighted rules (score 0-1).
WEIGHTED_RULES = (
    Rule("R1_EXTREME_AMOUNT", "Extreme Spending Outlier", 0.30, lambda x: (x.amt >= 1500.0) & (x.user_ratio >= 4.0),
         "Transaction amount is exceptionally high and exceeds 4x customer historical average."),
    Rule("R2_VELOCITY_SPIKE", "Rapid Transaction Velocity Burst", 0.35, lambda x: x.v1h >= 3,
         "Rapid burst of 3 or more transactions on this card within a 60-minute window."),
    Rule("R3_IMPOSSIBLE_TRAVEL", "Geographical Distance Discrepancy", 0.30, lambda x: x.distance >= 800.0,
         "Transaction initiated over 800 km away from cardholder's billing home location."),
    Rule("R4_LATE_NIGHT_HIGH_VALUE", "High-Value Off-Hours Transaction", 0.25, lambda x: x.night & (x.cat_ratio >= 3.0),
         "Significant purchase executed during late night / early morning hours (12 AM - 5 AM)."),
    Rule("R5_HIGH_RISK_CATEGORY", "Elevated Risk Merchant Category Spike", 0.20, lambda x: x.risky & (x.amt >= 500.0),
         "High-value checkout in historically high-fraud categories (digital goods, online retail)."),
)


# The wording of the signals' messages.
def _amount_text(x: Inputs) -> Column:
    return F.concat(F.lit("Transaction amount ($"), fixed(x.amt, 2), F.lit(") exceeds $500 and is "),
                    fixed(x.cat_ratio, 1), F.lit("x the category median."))


def _spike_text(x: Inputs) -> Column:
    return F.concat(F.lit("Order value is "), fixed(x.user_ratio, 1),
                    F.lit("x higher than this cardholder's baseline average spend."))


def _jump_text(x: Inputs) -> Column:
    return F.concat(F.lit("Terminal location is "), fixed(x.distance, 1),
                    F.lit(" km away from registered billing address."))


def _burst_text(x: Inputs) -> Column:
    return F.concat(F.lit("Card velocity spike: "), x.v1h.cast("bigint").cast("string"), F.lit(" txns in last hour, "),
                    x.v24h.cast("bigint").cast("string"), F.lit(" txns in 24 hours."))


def _sector_text(x: Inputs) -> Column:
    return F.concat(F.lit("High nominal order ($"), fixed(x.amt, 2),
                    F.lit(") placed in elevated chargeback sector '"), x.category, F.lit("'."))


# The six behaviour signals (points, scaled by severity).
BEHAVIOUR_SIGNALS = (
    Rule("SIG_EXTREME_AMOUNT", "Extreme Amount Outlier", 25.0, lambda x: (x.amt >= 500.0) & (x.cat_ratio >= 3.0),
         severity=lambda x: F.least(F.lit(1.0), x.amt / 1000.0 * 0.8), message=_amount_text),
    Rule("SIG_SPEND_SPIKE", "Cardholder Spend Spike", 30.0, lambda x: x.user_ratio >= 4.0,
         severity=lambda x: F.least(F.lit(1.0), x.user_ratio / 8.0), message=_spike_text),
    Rule("SIG_DISTANCE_JUMP", "Geographical Jump", 20.0, lambda x: x.distance >= 300.0,
         severity=lambda x: F.least(F.lit(1.0), x.distance / 1200.0), message=_jump_text),
    Rule("SIG_VELOCITY_BURST", "High Velocity Burst", 20.0, lambda x: (x.v1h >= 2) | (x.v24h >= 4),
         severity=lambda x: F.least(F.lit(1.0), F.when(x.v1h >= 2, x.v1h / 3.0).otherwise(x.v24h / 6.0)),
         message=_burst_text),
    Rule("SIG_OFF_HOURS", "Late Night / Off-Hours", 15.0, lambda x: x.night,
         severity=lambda x: F.when(x.amt < 200, F.lit(0.7)).otherwise(F.lit(1.0)),
         message=lambda x: F.lit("Transaction authorized during vulnerable midnight-to-dawn window (12 AM - 5 AM).")),
    Rule("SIG_HIGH_RISK_CATEGORY", "High-Dispute Sector", 10.0, lambda x: x.risky & (x.amt >= 250.0),
         severity=lambda x: F.lit(0.8), message=_sector_text),
)


def fired(df: DataFrame, rule: Rule) -> Column:
    return rule.fires(Inputs(df))


def points(df: DataFrame, rules: tuple[Rule, ...]) -> Column:
    """Sum of weight times severity over the rules that fire."""
    x = Inputs(df)
    parts = [F.when(r.fires(x), F.lit(r.weight) * r.severity(x)).otherwise(F.lit(0.0)) for r in rules]
    return reduce(lambda a, b: a + b, parts)


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = WEIGHTED_RULES) -> DataFrame:
    """Adds ``rule_score`` (0-1), ``triggered_rules`` and ``rule_count``."""
    x = Inputs(df)
    hits = F.array_compact(
        F.array(*[
            F.when(r.fires(x), F.struct(
                F.lit(r.rule_id).alias("rule_id"), F.lit(r.name).alias("name"),
                F.lit(r.weight).alias("weight"), F.lit(r.description).alias("description"),
            )) for r in rules
        ])
    )
    return df.withColumns(
        {"rule_score": half_even(F.least(F.lit(1.0), points(df, rules)), 4), "triggered_rules": hits}
    ).withColumn("rule_count", F.size("triggered_rules"))


def apply_signals(df: DataFrame, rules: tuple[Rule, ...] = BEHAVIOUR_SIGNALS, details: bool = True) -> DataFrame:
    """Adds ``behavioral_score`` (0-100) and, with ``details``, the fired ``signals`` and their count."""
    x = Inputs(df)
    score = clip(half_even(points(df, rules), 1), 0.0, 100.0)
    if not details:
        return df.withColumn("behavioral_score", score)
    hits = F.array_compact(
        F.array(*[
            F.when(r.fires(x), F.struct(
                F.lit(r.name).alias("signal"), F.lit(True).alias("triggered"),
                half_even(r.severity(x), 2).alias("severity"), r.message(x).alias("explanation"),
            )) for r in rules
        ])
    )
    return df.withColumns({"behavioral_score": score, "signals": hits}).withColumn("signal_count", F.size("signals"))


def signal_counts(df: DataFrame, rules: tuple[Rule, ...] = BEHAVIOUR_SIGNALS) -> DataFrame:
    """Per signal: rows where it fired, and rows whose total score reaches the signal's weight.
    One pass of conditional counts; a signal that never fires keeps its row."""
    x, score = Inputs(df), clip(half_even(points(df, rules), 1), 0.0, 100.0)
    counts = df.agg(F.array(*[
        F.struct(
            F.lit(r.name).alias("signal"),
            F.count_if(r.fires(x)).alias("triggered_rows"),
            F.count_if(score >= r.weight).alias("score_reaches_weight"),
        ) for r in rules
    ]).alias("_counts"))
    return counts.select(F.inline("_counts"))
