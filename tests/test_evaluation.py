from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.config import SWEEP_9, SWEEP_37, WITH_OPERATIONS, WITHOUT_OPERATIONS
from riskspark.operators import curves, fusion, metrics
from riskspark.operators.cost import cheapest, confusion, cost_breakdown, policy_comparison, sweep
from riskspark.operators.curves import curve_areas, curve_points


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for _ in range(400):
        y = int(rng.random() < 0.1)
        p = min(1.0, max(0.0, rng.gauss(0.6 if y else 0.3, 0.2)))
        out.append((y, round(p, 2), int(p * 100), round(rng.random() * 900, 2)))
    return out


@pytest.fixture(scope="module")
def scored(spark, rows):
    return spark.createDataFrame(rows, "is_fraud int, p double, score int, amt double").persist()


def brute_areas(y, s):
    y, s = np.array(y), np.array(s)
    recall, precision, fpr = [0.0], [1.0], [0.0]
    for t in sorted(set(s), reverse=True):
        tp, fp = ((s >= t) & (y == 1)).sum(), ((s >= t) & (y == 0)).sum()
        recall.append(tp / (y == 1).sum())
        precision.append(tp / (tp + fp))
        fpr.append(fp / (y == 0).sum())
    trapezoid = lambda x, v: sum((x[i] - x[i - 1]) * (v[i] + v[i - 1]) / 2 for i in range(1, len(x)))
    return trapezoid(recall, precision), trapezoid(fpr, recall)


def test_areas(scored, rows):
    want = brute_areas([r[0] for r in rows], [r[1] for r in rows])
    got = curve_areas(scored, F.col("p"), digits=None).first()
    assert (got.pr_auc, got.roc_auc) == pytest.approx(want, rel=1e-12)


def test_areas_of_any_scale_and_close_scores(spark):
    data = [(1, -3.5), (0, -1e-9), (1, 0.90000012), (0, 0.90000011), (0, 55.0), (1, 1e9), (1, float("nan")), (0, None)]
    df = spark.createDataFrame(data, "is_fraud int, p double")
    got = curve_areas(df, F.col("p"), digits=None).first()
    assert (got.pr_auc, got.roc_auc) == pytest.approx(brute_areas([d[0] for d in data[:6]], [d[1] for d in data[:6]]), rel=1e-12)


def test_full_resolution_with_crowded_scores(spark):
    rng = random.Random(9)
    data = [(int(rng.random() < 0.2), rng.choice([0.0, 1.0, 1e-9 * rng.random(), 1 - 1e-9 * rng.random(), rng.random()])) for _ in range(500)]
    df = spark.createDataFrame(data, "is_fraud int, p double")
    got = curve_areas(df, F.col("p"), digits=None).first()
    assert (got.pr_auc, got.roc_auc) == pytest.approx(brute_areas([d[0] for d in data], [d[1] for d in data]), rel=1e-12)


def test_areas_without_one_class(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.9)], "is_fraud int, p double")
    assert tuple(curve_areas(df, F.col("p")).first()) == (0.0, 0.0)


def test_weight_grid_moves_rows_once_in_many_tasks(spark, monkeypatch):
    """Tasks follow the rows of the grid, 900 of them here, and slice totals need no rows moved."""
    rng = random.Random(7)
    rows = [(int(rng.random() < 0.2), rng.random(), rng.random()) for _ in range(300)] + [(1, None, 0.5)]
    df = spark.createDataFrame(rows, "is_fraud int, a double, b double")
    sets = [(0, 0.7, 0.3, 0.0), (1, 0.5, 0.5, 0.0), (2, 0.0, 1.0, 0.0)]
    monkeypatch.setattr(curves, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(fusion, "SOURCE_ROWS", 200)
    out = fusion.grid_areas(df, iter(sets), F.col("w_ml") * F.col("a") + F.col("w_anomaly") * F.col("b"), ("a", "b"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("), REPARTITION_BY_NUM") == 3 and "REPARTITION_BY_COL" not in plan  # sources for rows and totals, rows
    assert plan.count(", 10), REPARTITION_BY_NUM") == 1 and plan.count(", 5), REPARTITION_BY_NUM") == 2
    kept = [x for x in plan.splitlines() if "Exchange" in x and "coalesce(config" in x]
    assert not kept, "rows stay in the task of their slice for the join"
    for r in out.collect():
        _, x, y, _ = sets[r.config]
        known = [(l, x * a + y * b) for l, a, b in rows if a is not None]
        assert (r.pr_auc, r.roc_auc) == pytest.approx(brute_areas(*zip(*known)), abs=1e-6)


def test_curve_is_monotone(scored):
    pts = curve_points(scored, F.col("p")).orderBy(F.col("threshold").desc()).collect()
    assert all(a.recall <= b.recall and a.fpr <= b.fpr for a, b in zip(pts, pts[1:]))
    assert pts[-1].recall == 1 and pts[-1].fpr == 1


def brute_cost(rows, column, t, operational):
    cell = lambda y, f: [r for r in rows if r[0] == y and (r[column] >= t) == f]
    tp, fp, fn = cell(1, True), cell(0, True), cell(1, False)
    fn_cost = sum(r[3] for r in fn) + len(fn) * (20 + operational)
    fp_cost = sum(r[3] for r in fp) * 0.2 + len(fp) * 10
    return len(tp), len(fp), len(fn), fn_cost, fp_cost, fn_cost + fp_cost


@pytest.mark.parametrize("column,thresholds", [("p", SWEEP_9), ("p", SWEEP_37), ("score", tuple(range(1, 100)))])
def test_sweep_against_definition(scored, rows, column, thresholds):
    index = {"p": 1, "score": 2}[column]
    got = sweep(scored, column, thresholds).orderBy("threshold").collect()
    assert len(got) == len(thresholds)
    for r in got:
        want = brute_cost(rows, index, r.threshold, 5)
        assert (r.tp, r.fp, r.fn) == want[:3] and r.tp + r.fp + r.fn + r.tn == len(rows)
        assert (r.fn_cost, r.fp_cost, r.total_cost) == pytest.approx(want[3:], abs=0.006)
    assert all(a.recall >= b.recall for a, b in zip(got, got[1:]))


def test_published_cost_identities(spark):
    # Frauds worth 89,810.09 all missed: 119 * 20 fees, and 119 * 5 with operations.
    rows = [(1, 750.0, 0)] * 118 + [(1, 89810.09 - 118 * 750.0, 0), (0, 10.0, 0)]
    df = spark.createDataFrame(rows, "is_fraud int, amt double, score int")
    assert cost_breakdown(df, F.col("score") >= 1, WITH_OPERATIONS).first().fn_cost == 92785.09
    assert cost_breakdown(df, F.col("score") >= 1, WITHOUT_OPERATIONS).first().fn_cost == 92190.09
    policy = policy_comparison(df, F.col("is_fraud") == 1, WITHOUT_OPERATIONS).first()
    assert (policy.unmitigated_cost, policy.net_savings, policy.preservation_pct) == (92190.09, 92190.09, 100.0)


def test_cheapest_takes_the_lowest_of_equals(spark):
    df = spark.createDataFrame([(1, 10.0, 80), (0, 10.0, 10)], "is_fraud int, amt double, score int")
    assert cheapest(sweep(df, "score")).first().threshold == 11


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(1, 10.0, 0)], "is_fraud int, amt double, score int")
    row = metrics.metrics_at(df, "score", 1).first()
    assert (row.precision, row.recall, row.f1, row.fpr) == (0, 0, 0, 0)


def test_confusion_sums(scored):
    row = confusion(scored, F.col("p") >= 0.4).first()
    assert row.tp + row.fp + row.fn + row.tn == 400


def test_config_selection_ties(spark):
    schema = "config string, pr_auc double, total_cost double"
    pick = lambda data: metrics.select_config(spark.createDataFrame(data, schema)).first().config
    assert pick([("A", 1.0, 5.0), ("B", 0.9995, 5.0), ("C", 1.0, 6.0)]) == "B"
    assert pick([("A", 0.9, 5.0), ("B", 0.9, 5.0)]) == "A"
    assert pick([("A", 1.0, 5.0), ("B", 1.0, 4.0)]) == "B"
    listed = spark.createDataFrame([("A", 1.0, 5.0), ("B", 1.0, 5.0)], schema)
    assert metrics.select_config(listed, order=("B", "A")).first().config == "A"


def test_best_weights_first_wins(spark):
    df = spark.createDataFrame([(c, y, p) for c in (0, 1, 2) for y, p in ((1, 0.9 if c else 0.1), (0, 0.5))], "config int, is_fraud int, p double")
    assert metrics.best_weights(df, F.col("p")).first().config == 1


def test_error_samples(scored):
    out = metrics.error_samples(scored.withColumn("trans_num", F.monotonically_increasing_id()), F.col("p") >= 0.5)
    assert {(r.outcome, r.place) for r in out.collect()} == {("fp", 1), ("fp", 2), ("fn", 1), ("fn", 2)}
