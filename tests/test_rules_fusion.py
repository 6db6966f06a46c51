from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskspark.config import FROZEN_FUSION, LIVE_FUSION, UNIT_FUSION, simplex_weights
from riskspark.operators import fusion
from riskspark.operators.rules import BEHAVIOUR_SIGNALS, WEIGHTED_RULES, apply_rules, apply_signals, signal_counts
from riskspark.plans import jobs

# Inputs are partial records: what is not named takes its neutral value.
CASES = {
    "R1_EXTREME_AMOUNT": ({"amt": 1500.0, "amt_to_user_avg_ratio": 4.0}, {"amt": 1500.0, "amt_to_user_avg_ratio": 3.9}),
    "R2_VELOCITY_SPIKE": ({"trans_velocity_1h": 3.0}, {"trans_velocity_1h": 2.0}),
    "R3_IMPOSSIBLE_TRAVEL": ({"haversine_distance_km": 800.0}, {"haversine_distance_km": 799.9}),
    "R4_LATE_NIGHT_HIGH_VALUE": ({"is_night_transaction": 1.0, "amt_to_cat_median_ratio": 3.0}, {"is_night_transaction": 0.0, "amt_to_cat_median_ratio": 3.0}),
    "R5_HIGH_RISK_CATEGORY": ({"category": "SHOPPING_NET", "amt": 500.0}, {"category": "travel", "amt": 500.0}),
}


def one(spark, record):
    return spark.createDataFrame([tuple(record.values())], list(record))


@pytest.mark.parametrize("rule_id", CASES)
def test_each_rule(spark, rule_id):
    hit, miss = CASES[rule_id]
    assert [r.rule_id for r in apply_rules(one(spark, hit)).first().triggered_rules] == [rule_id]
    assert apply_rules(one(spark, miss)).first().rule_count == 0


def test_rule_score_is_capped(spark):
    record = {"amt": 2000.0, "amt_to_user_avg_ratio": 9.0, "trans_velocity_1h": 5.0, "haversine_distance_km": 2000.0, "is_night_transaction": 1.0,
              "amt_to_cat_median_ratio": 8.0, "category": "misc_net"}
    row = apply_rules(one(spark, record)).first()
    assert row.rule_score == 1.0 and row.rule_count == len(WEIGHTED_RULES)


def test_signals_by_hand(spark):
    record = {"amt": 865.2, "amt_to_user_avg_ratio": 7.8, "amt_to_cat_median_ratio": 4.5, "haversine_distance_km": 1450.0,
              "trans_velocity_1h": 3.0, "trans_velocity_24h": 5.0, "is_night_transaction": 1.0, "category": "shopping_net"}
    row = apply_signals(one(spark, record)).first()
    points = 25 * min(1, 0.8652 * 0.8) + 30 * min(1, 7.8 / 8) + 20 + 20 + 15 + 10 * 0.8
    assert row.behavioral_score == pytest.approx(min(100, round(points, 1)))
    assert row.signal_count == 6
    assert row.signals[0].explanation == "Transaction amount ($865.20) exceeds $500 and is 4.5x the category median."
    assert row.signals[3].explanation == "Card velocity spike: 3 txns in last hour, 5 txns in 24 hours."


def test_velocity_signal_prefers_the_hour(spark):
    burst = lambda a, b: apply_signals(one(spark, {"trans_velocity_1h": a, "trans_velocity_24h": b})).first().behavioral_score
    assert burst(2.0, 6.0) == 13.3
    assert burst(1.0, 4.0) == 13.3
    assert burst(1.0, 3.0) == 0


def test_neutral_record(spark):
    empty = spark.createDataFrame([(None, None)], "amt double, category string")
    row = apply_signals(apply_rules(empty)).first()
    assert (row.rule_score, row.behavioral_score, row.signals) == (0, 0, [])


def test_signal_counts_keep_silent_signals(spark):
    rows = {r.signal: r.triggered_rows for r in signal_counts(one(spark, {"amt": 1.0})).collect()}
    assert rows == {r.name: 0 for r in BEHAVIOUR_SIGNALS}


@pytest.mark.parametrize("inputs,score,level", [((0.0, 0.0, 0.0), 0, "LOW RISK"), ((1.0, 1.0, 1.0), 100, "HIGH RISK"), ((0.5, 0.5, 0.5), 50, "MEDIUM RISK")])
def test_unit_fusion(spark, inputs, score, level):
    df = spark.createDataFrame([inputs], "p_ml double, s_anom double, behavioral_score double")
    row = fusion.apply_fusion(df, UNIT_FUSION).first()
    assert (row.hybrid_score, row.risk_level) == (score, level)


def test_weights_are_normalized(spark):
    w = fusion.normalized(F.lit(6.0), F.lit(2.0), F.lit(2.0))
    assert tuple(spark.range(1).select(*w).first()) == pytest.approx((0.6, 0.2, 0.2))


def test_tier_bounds(spark):
    df = spark.createDataFrame([(s,) for s in (35, 36, 69, 70)], "s int")
    live = [r[0] for r in df.select(fusion.tier(F.col("s"), F.lit(LIVE_FUSION.low_max), F.lit(LIVE_FUSION.medium_max))).collect()]
    unit = [r[0] for r in df.select(fusion.tier(F.col("s"), F.lit(UNIT_FUSION.low_max), F.lit(UNIT_FUSION.medium_max))).collect()]
    assert live == ["LOW RISK", "MEDIUM RISK", "MEDIUM RISK", "HIGH RISK"]
    assert unit == ["LOW RISK", "MEDIUM RISK", "MEDIUM RISK", "MEDIUM RISK"]


def test_grid_has_fifty_weight_sets():
    grid = simplex_weights()
    assert len(grid) == 50 and all(abs(sum(g[1:]) - 1) < 1e-9 for g in grid)


def test_parts_add_up(spark):
    df = spark.createDataFrame([(0.986, 77.3, 30.8)], "p_ml double, s_anom double, behavioral_score double")
    b = fusion.score_breakdown(df, FROZEN_FUSION).first().score_breakdown
    assert b.hybrid_score == round(b.ml_contribution + b.anomaly_contribution + b.behavioral_contribution) == 76
    assert fusion.score_breakdown(df, LIVE_FUSION).first().score_breakdown.hybrid_score == 84


def test_calibration(spark):
    df = spark.createDataFrame([(-0.9,), (-0.6,), (-0.3,)], "raw double")
    got = [r[0] for r in df.select(fusion.calibrate_anomaly(F.col("raw"), F.lit(-0.8), F.lit(-0.4))).collect()]
    assert got == [100.0, 50.0, 0.0]


# Scenario records: behaviour score by hand, the model-free part of the regression set.
SCENARIOS = {
    "grocery": ({"amt": 42.5, "category": "grocery_pos", "haversine_distance_km": 3.8, "amt_to_user_avg_ratio": 0.85, "amt_to_cat_median_ratio": 0.95,
                 "trans_velocity_1h": 0, "trans_velocity_24h": 1, "is_night_transaction": 0}, 0.0),
    "burst": ({"amt": 280.0, "category": "shopping_net", "haversine_distance_km": 15.0, "amt_to_user_avg_ratio": 4.2, "amt_to_cat_median_ratio": 3.1,
               "trans_velocity_1h": 4, "trans_velocity_24h": 7, "is_night_transaction": 0}, 15.75 + 20 + 8),
    "travel": ({"amt": 650.0, "category": "shopping_pos", "haversine_distance_km": 1450.0, "amt_to_user_avg_ratio": 7.5, "amt_to_cat_median_ratio": 4.8,
                "trans_velocity_1h": 1, "trans_velocity_24h": 3, "is_night_transaction": 0}, 13 + 28.125 + 20 + 8),
    "late": ({"amt": 1750.0, "category": "misc_net", "haversine_distance_km": 820.0, "amt_to_user_avg_ratio": 12.4, "amt_to_cat_median_ratio": 6.5,
              "trans_velocity_1h": 2, "trans_velocity_24h": 4, "is_night_transaction": 1}, 100.0),
    "dining": ({"amt": 165.0, "category": "food_dining", "haversine_distance_km": 280.0, "amt_to_user_avg_ratio": 2.1, "amt_to_cat_median_ratio": 2.4,
                "trans_velocity_1h": 0, "trans_velocity_24h": 2, "is_night_transaction": 0}, 0.0),
}


def test_scenarios(spark):
    names = list(SCENARIOS)
    fields = list(SCENARIOS["grocery"][0])
    df = spark.createDataFrame([(n, *[SCENARIOS[n][0][f] for f in fields], 0.9, 90.0) for n in names], ["trans_num", *fields, "p_ml", "s_anom"])
    rows = {r.trans_num: r for r in jobs.score_table(df).collect()}
    for n in names:
        # half-even rounding to one digit of the hand-added points
        assert rows[n].behavioral_score == pytest.approx(SCENARIOS[n][1], abs=0.051)
        assert 0 <= rows[n].hybrid_score <= 100
    assert rows["late"].hybrid_score >= 70 and rows["late"].risk_level == "HIGH RISK"
    assert rows["grocery"].explanation.startswith("Elevated statistical anomaly")
    assert rows["travel"].explanation.startswith("Flagged by 4 risk signal(s): Extreme Amount Outlier; ")


def test_result_record(spark, txns):
    from riskspark.catalog.views import with_surrogates
    from riskspark.operators.features import Baselines, add_features

    df = with_surrogates(add_features(txns, Baselines.fit(txns)))
    rows = jobs.explain_table(jobs.score_table(df)).collect()
    assert len(rows) == txns.count()
    for r in rows:
        b = r.score_breakdown
        assert abs(b.hybrid_score - min(100, b.ml_contribution + b.anomaly_contribution + b.behavioral_contribution)) <= 0.52
        assert r.explanation_summary and r.risk_level in ("LOW RISK", "MEDIUM RISK", "HIGH RISK")


def test_requests_become_scorable(spark):
    df = spark.createDataFrame([(1.0, 3, 111.0, None), (1.0, None, None, 0)], "amt double, hour int, haversine_distance_km double, is_night_transaction int")
    night, plain = jobs.request_table(df).collect()
    assert night.is_night_transaction == 1 and night.merch_lat == pytest.approx(night.lat + 1)
    assert (night.trans_ts.isoformat(), plain.trans_ts.hour) == ("2026-08-27T03:30:00", 14)
    assert night.trans_ts.weekday() == 3  # the fixed day is a Thursday
