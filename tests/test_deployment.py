from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskspark.config import FEATURES, FROZEN_FUSION
from riskspark.ml import supervised
from riskspark.ml.iforest import IsolationForest
from riskspark.operators.features import Baselines, add_features
from riskspark.plans import scenarios
from riskspark.plans.deployment import Deployment, answer_requests, checked_requests, with_defaults


@pytest.fixture(scope="module")
def deployment(txns):
    base = Baselines.fit(txns)
    df = add_features(txns, base).select("trans_num", "is_fraud", *FEATURES).persist()
    return Deployment(supervised.fit_forest(df, 20, 5), IsolationForest.fit(df, trees=40), base, FROZEN_FUSION)


def test_round_trip_by_version(spark, txns, deployment, tmp_path):
    root = str(tmp_path)
    deployment.save(spark, root, 1)
    other = Deployment(deployment.model, deployment.forest, deployment.baselines, replace(FROZEN_FUSION, cutoff=40))
    other.save(spark, root, 3)
    newest, first = Deployment.load(spark, root), Deployment.load(spark, root, 1)
    assert newest.fusion == other.fusion and first.fusion == FROZEN_FUSION and first.model.features == deployment.model.features
    rows = add_features(txns.limit(50), deployment.baselines)
    keep = ("trans_num", "p_ml", "s_anom", "hybrid_score")
    assert first.scored(rows).select(*keep).exceptAll(deployment.scored(rows).select(*keep)).count() == 0
    with pytest.raises(ValueError):
        Deployment.load(spark, root, 2)


def test_requests_are_checked_and_explained(spark, deployment):
    schema = "trans_num string, amt double, hour int, customer_age double, haversine_distance_km double"
    rows = [("ok", 20.0, None, None, None), ("night", 900.0, 3, 40.0, 2000.0), ("free", 0.0, 1, 40.0, 1.0), ("none", None, 1, 40.0, 1.0), ("odd", 5.0, 24, 17.0, -1.0)]
    answers, refused = answer_requests(spark.createDataFrame(rows, schema), deployment)
    why = {r["trans_num"]: r["violations"] for r in refused.collect()}
    assert why == {"free": ["amt"], "none": ["amt"], "odd": ["hour", "customer_age", "haversine_distance_km"]}
    got = {r["transaction_id"]: r for r in answers.collect()}
    assert set(got) == {"ok", "night"}
    assert any(s["signal"] == "Geographical Jump" for s in got["night"]["behavioral_signals"])
    assert got["night"]["behavioral_risk"] > got["ok"]["behavioral_risk"] and got["ok"]["explanation_summary"]
    assert len(got["night"]["top_risk_factors"]) + len(got["night"]["protective_factors"]) > 0


def test_defaults(spark):
    row = with_defaults(spark.createDataFrame([(5.0,)], "amt double")).first()
    assert row["trans_num"] == "TXN_LIVE" and row["hour"] == 14 and row["is_night_transaction"] is None
    accepted, refused = checked_requests(spark.createDataFrame([], "amt double"))
    assert accepted.count() == refused.count() == 0


def test_known_cases(spark, deployment):
    """The known cases as requests: all accepted, and those expected high above those expected low."""
    cases = scenarios.records(spark)
    answers, refused = answer_requests(cases, deployment)
    assert refused.count() == 0 and answers.count() == len(scenarios.RECORDS)
    scores = answers.join(cases, F.col("transaction_id") == F.col("trans_num")).select("expected_tier", "hybrid_score", "behavioral_risk", "risk_level").collect()
    high, low = ([r for r in scores if r["expected_tier"] == t] for t in ("HIGH RISK", "LOW RISK"))
    assert min(r["behavioral_risk"] for r in high) > max(r["behavioral_risk"] for r in low)
    assert min(r["hybrid_score"] for r in high) > max(r["hybrid_score"] for r in low)
    assert all(r["risk_level"] == "LOW RISK" for r in low)
