from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.ml import attribution, supervised
from riskspark.ml.iforest import IsolationForest, mean_path
from riskspark.operators.features import Baselines, add_features

FEATURES = ("amt", "haversine_distance_km", "amt_to_user_avg_ratio", "hour")


@pytest.fixture(scope="module")
def frame(txns):
    df = add_features(txns, Baselines.fit(txns), velocity=False)
    return df.select("trans_num", "is_fraud", *FEATURES).persist()


def test_balanced_weights_sum_equally(frame):
    sums = {r.is_fraud: r.w for r in supervised.balanced_weights(frame).groupBy("is_fraud").agg(F.sum(supervised.WEIGHT).alias("w")).collect()}
    assert sums[0] == pytest.approx(sums[1]) == pytest.approx(frame.count() / 2)


def test_forest_flags_extremes(spark, frame, tmp_path):
    forest = IsolationForest.fit(frame, FEATURES, trees=30)
    far = frame.limit(1).withColumns({"amt": F.lit(1e5), "haversine_distance_km": F.lit(2e4), "amt_to_user_avg_ratio": F.lit(200.0)})
    scores = [r.s_anom for r in forest.with_scores(frame).select("s_anom").collect()]
    assert all(0 <= s <= 100 for s in scores)
    assert forest.with_scores(far).first().s_anom > np.quantile(scores, 0.99)
    forest.save(spark, str(tmp_path))
    again = IsolationForest.load(spark, str(tmp_path))
    assert [r.s_anom for r in again.with_scores(frame).select("s_anom").collect()] == scores


def test_forest_is_repeatable_and_bounded(frame):
    a, b = (IsolationForest.fit(df, FEATURES, trees=7, sample=64) for df in (frame, frame.repartition(5)))
    assert a.nodes.reset_index(drop=True).equals(b.nodes.reset_index(drop=True))
    roots = a.nodes[a.nodes["node"] == 0]
    assert len(roots) == 7 and (roots["rows"] == 64).all()
    assert a.nodes["path"].max() <= 6 + mean_path(64)


def test_small_table_is_dealt_in_turns(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("trans_num"), F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    forest = IsolationForest.fit(df, ("x", "y"), trees=5, sample=30)
    assert (forest.nodes[forest.nodes["node"] == 0]["rows"] == 30).all()


def total(row):
    return row.base_value + sum(c.contribution for c in row.contributions)


@pytest.mark.parametrize("kind", ["boosted", "forest", "logistic"])
def test_contributions_add_up_to_the_output(frame, kind):
    model = {
        "boosted": lambda: supervised.fit_boosted(frame, {"n_estimators": 4, "max_depth": 3}, FEATURES),
        "forest": lambda: supervised.fit_forest(frame, 5, 4, FEATURES),
        "logistic": lambda: supervised.fit_logistic(frame, FEATURES, max_iter=5),
    }[kind]()
    for r in attribution.explain(model, model.with_probability(frame)).limit(200).collect():
        output = r.p_ml if kind == "forest" else np.log(r.p_ml / (1 - r.p_ml))
        assert total(r) == pytest.approx(output, abs=1e-6)


def enumerated(amount, conditions, met):
    """Shapley values over all coalitions of the game amount * product(met or share)."""
    share, d = [z for _, _, z in conditions.values()], len(conditions)
    game = lambda known: amount * np.prod([met[j] if j in known else share[j] for j in range(d)])
    return [
        sum(factorial(len(s)) * factorial(d - 1 - len(s)) / factorial(d) * (game({*s, i}) - game(set(s)))
            for k in range(d) for s in combinations([j for j in range(d) if j != i], k))
        for i in range(d)
    ]


@pytest.mark.parametrize("d", [1, 2, 3, 6, 9])
def test_leaf_is_the_shapley_value(d):
    rng = np.random.default_rng(d)
    conditions = {2 * j: (0.0, 1.0, z) for j, z in enumerate(rng.uniform(0.05, 0.95, d))}
    leaves = attribution.grouped([(4.0, conditions), (-1.5, conditions)])
    patterns = rng.integers(0, 2, (12, d))
    x = np.full((12, 2 * d), 9.0)
    x[:, ::2] = np.where(patterns == 1, 0.5, 2.0)
    got = attribution._batch(x, leaves, 2 * d)
    for row, met in zip(got, patterns):
        assert row[::2] == pytest.approx(enumerated(2.5, conditions, list(met)), abs=1e-12) and not row[1::2].any()


@pytest.mark.parametrize("limit", [0, 3000, 1 << 20])
def test_looked_up_answers_are_the_quadrature(limit):
    """Leaves with and without room for their answers; features that share a condition, and rows on a bound."""
    rng = np.random.default_rng(5)
    found = [(float(v), {int(j): (0.25, float(rng.choice([0.5, np.inf])), float(rng.uniform(0.1, 0.9))) for j in rng.permutation(7)[: 1 + i % 6]}) for i, v in enumerate(rng.normal(size=40))]
    leaves, x = attribution.grouped(found), rng.choice([0.0, 0.25, 0.4, 0.5, 0.6, np.nan], (300, 7))
    tables = attribution.Tables(leaves, 7, limit)
    assert len(tables.answers) + sum(len(g.amount) for g in tables.rest) == 40 and (len(tables.rest) == 0) == (limit == 1 << 20)
    assert attribution._batch(x, [tables], 7) == pytest.approx(attribution._batch(x, leaves, 7), abs=1e-12)


def test_forest_scores_its_rows_once_for_the_bounds(frame, monkeypatch):
    """The bounds are read from written scores, not from a plan that scores again for each use."""
    from riskspark.ml import iforest

    plans, bounds = [], iforest.calibration_bounds
    monkeypatch.setattr(iforest, "calibration_bounds", lambda df, raw="raw": plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or bounds(df, raw))
    IsolationForest.fit(frame, FEATURES, trees=3, sample=16)
    assert len(plans) == 1 and "ArrowEvalPython" not in plans[0]


def test_deep_trees_on_noisy_labels(frame):
    """150 rounds of depth 10 over labels that follow nothing: leaves of every depth, additive, and few bytes."""
    noisy = frame.withColumn("is_fraud", (F.xxhash64("trans_num") % 2 == 0).cast("int"))
    model = supervised.fit_histogram_boosting(noisy, rounds=150, depth=10, features=FEATURES)
    leaves, _ = attribution.tree_leaves(noisy.sparkSession, model)
    assert sum(len(g.amount) for g in leaves) > 3000 and sum(g.bytes for g in leaves) < 20 << 20
    for r in attribution.explain(model, model.with_probability(noisy)).collect():
        output = np.log(r.p_ml / (1 - r.p_ml))
        assert total(r) == pytest.approx(output, abs=1e-6)


def test_large_models_are_refused(frame, monkeypatch):
    model = supervised.fit_forest(frame, 2, 3, FEATURES)
    monkeypatch.setattr(attribution, "MODEL_BYTES", 10)
    with pytest.raises(ValueError):
        attribution.explain(model, frame)


def test_model_round_trip_and_selection(frame, tmp_path):
    good = supervised.fit_forest(frame, 5, 4, FEATURES)
    poor = supervised.fit_forest(frame, 1, 1, ("hour",))
    best, scores = supervised.select_model([poor, good], frame)
    assert best is good and scores.count() == 2
    good.save(str(tmp_path / "m"))
    loaded = supervised.FraudModel.load("again", str(tmp_path / "m"))
    p = lambda m: [r.p_ml for r in m.with_probability(frame).orderBy("trans_num").select("p_ml").collect()]
    assert p(loaded) == p(good)


def test_permutation_uses_every_value_once(frame):
    from riskspark.operators.split import hash_order

    placed = supervised._with_positions(frame, hash_order("trans_num", 1), "at")
    assert sorted(r["at"] for r in placed.select("at").collect()) == list(range(frame.count()))
