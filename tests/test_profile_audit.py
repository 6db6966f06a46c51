from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import audit
from riskspark.operators import explain as X
from riskspark.operators import profile as P


def test_bands_and_tiers_keep_empty_rows(spark):
    df = spark.createDataFrame([(0.0, "LOW RISK", 0), (25.0, "LOW RISK", 1), (25.1, "HIGH RISK", 0), (100.0, "HIGH RISK", 1)], "s double, risk_level string, is_fraud int")
    bands = {r.band: (r.total, r.fraud) for r in P.band_rates(df, "s").collect()}
    assert bands == {"0-25": (2, 1), "25-50": (1, 0), "50-75": (0, 0), "75-100": (1, 1)}
    tiers = {r.risk_level: (r.total, r.fraud_count, r.fraud_rate_pct) for r in P.tier_allocation(df).collect()}
    assert tiers == {"LOW RISK": (2, 1, 50.0), "MEDIUM RISK": (0, 0, 0.0), "HIGH RISK": (2, 1, 50.0)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (2.5, 0), (99.9, 0), (100.0, 0)], "s double, is_fraud int")
    assert {r.bin: r.n for r in P.linear_histogram(df, "s").collect()} == {0: 1, 1: 1, 39: 2}


def test_log_histogram_density_integrates_to_one(txns):
    rows = P.log_histogram(txns).where("is_fraud = 0").collect()
    assert sum(r.density * (r.high - r.low) for r in rows) == pytest.approx(1, abs=1e-3)


def test_correlations_against_numpy(txns):
    pdf = txns.select("amt", "lat", "is_fraud").toPandas()
    want = np.corrcoef(pdf.to_numpy(float).T)
    got = {(r.feature_a, r.feature_b): r.correlation for r in P.correlation_matrix(txns, ("amt", "lat", "is_fraud")).collect()}
    names = ("amt", "lat", "is_fraud")
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert got[a, b] == pytest.approx(want[i, j], abs=6e-5)


def test_correlations_are_pairwise(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, 4.0, float("nan")), (4.0, 3.0, 1.0), (5.0, 2.5, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r.correlation for r in P.correlation_matrix(df, ("a", "b", "c")).collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef([r[0] for r in rows], [r[1] for r in rows])[0, 1], abs=6e-5)
    kept = [rows[i] for i in (1, 3, 4)]
    assert got["a", "c"] == pytest.approx(np.corrcoef([r[0] for r in kept], [r[2] for r in kept])[0, 1], abs=6e-5)


def test_cardinality_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    assert {r.column_name: r.distinct_values for r in P.cardinality(df).collect()} == {"x": 2, "y": 1}
    assert {r.column_name: r.distinct_values for r in P.cardinality(df, approximate=True).collect()} == {"x": 2, "y": 1}
    assert P.duplicate_rows(df).first().duplicate_rows == 1


def test_box_plot_against_numpy(txns):
    amounts = np.array([r.amt for r in txns.where("is_fraud = 0").select("amt").collect()])
    row = P.box_plot(txns.where("is_fraud = 0"), "amt", ("is_fraud",)).first()
    q1, q3 = np.quantile(amounts, [0.25, 0.75])
    inside = amounts[(amounts >= q1 - 1.5 * (q3 - q1)) & (amounts <= q3 + 1.5 * (q3 - q1))]
    assert (row.whisker_low, row.whisker_high) == pytest.approx((inside.min(), inside.max()), abs=1e-4)
    assert row.outliers == len(amounts) - len(inside)


def test_overlap_is_found(spark):
    df = spark.createDataFrame([("1", "train"), ("2", "val"), ("2", "test"), ("3", "test"), ("3", "test")], "trans_num string, split string")
    assert audit.id_overlap(df).first().asDict() == {"train_val_overlap": 0, "train_test_overlap": 0, "val_test_overlap": 1}
    assert [r.trans_num for r in audit.shared_ids(df).collect()] == ["2"]


def test_suspicious_feature_is_found(spark):
    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("is_fraud"), (F.col("id") % 2 * 3.0).alias("leak"), F.col("id").cast("double").alias("fine"))
    got = {r.feature: r.suspicious for r in audit.suspicious_features(df, ("leak", "fine")).collect()}
    assert got == {"leak": True, "fine": False}


def test_top_factors(spark):
    df = spark.createDataFrame([("t", 900.0, 3.0, 0.5)], "trans_num string, amt double, hour double, customer_age double")
    df = X.linear_contributions(df, {"amt": 0.01, "hour": -1.0, "customer_age": 0.0}, {"amt": 100.0, "hour": 1.0, "customer_age": 0.0}, 0.25)
    row = X.top_factors(df).first()
    assert [(f.feature, f.contribution) for f in row.top_risk_factors] == [("amt", 8.0)]
    assert [(f.feature, f.impact) for f in row.protective_factors] == [("hour", "decreases_risk")]
    assert row.base_value == 0.25
    assert [d.feature for d in X.bar_factors(df, 2).first().drivers] == ["amt", "hour"]


def test_case_studies_fall_back(spark):
    rows = [(f"{i:02d}", int(i == 3), float(i), "x", 0.1 * i, 10.0) for i in range(20)]
    df = spark.createDataFrame(rows, "trans_num string, is_fraud int, amt double, category string, p_ml double, s_anom double")
    got = {r.case: r.trans_num for r in X.case_studies(df).collect()}
    assert got == {"1_confirmed_fraud": "03", "2_routine_legitimate": "11", "3_moderate_anomaly": "00", "4_false_positive": "19", "5_borderline_fraud": "03"}
