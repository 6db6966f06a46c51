from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark.config import FEATURES
from riskspark.operators.features import Baselines, add_features, feature_matrix
from riskspark.operators.lookups import lookup_join


@pytest.fixture(scope="module")
def pair(spark):
    """One card, a local purchase and a far one a quarter of an hour later."""
    at = dt.datetime(2024, 1, 3, 12, 0)
    rows = [
        ("1", at, 7, "grocery_pos", 50.0, 12.97, 77.59, 12.98, 77.60, dt.date(1989, 5, 1), 0),
        ("2", at + dt.timedelta(minutes=15), 7, "shopping_net", 950.0, 12.97, 77.59, 19.07, 72.87, dt.date(1989, 5, 1), 1),
    ]
    schema = "trans_num string, trans_ts timestamp, cc_num long, category string, amt double, lat double, long double, merch_lat double, merch_long double, dob date, is_fraud int"
    return spark.createDataFrame(rows, schema)


def test_two_row_frame(pair):
    one, two = add_features(pair, Baselines.fit(pair)).orderBy("trans_num").collect()
    assert (one.trans_velocity_1h, two.trans_velocity_1h) == (0, 1)
    assert one.customer_age == 35 and one.day_of_week == 2 and one.hour == 12 and one.is_night_transaction == 0
    assert one.haversine_distance_km < 5 and 800 < two.haversine_distance_km < 900
    assert two.amt_to_user_avg_ratio == pytest.approx(950 / (500 + 1e-5))
    assert (one.category_fraud_rate, two.category_fraud_rate) == (0, 1)


def test_feature_matrix_columns(pair):
    assert feature_matrix(add_features(pair, Baselines.fit(pair))).columns == ["trans_num", *FEATURES]


def test_unseen_keys_take_global_values(pair):
    base = Baselines.fit(pair)
    new = pair.withColumns({"cc_num": F.lit(99).cast("long"), "category": F.lit("travel")})
    row = add_features(new, base).orderBy("trans_num").first()
    assert row.amt_to_user_avg_ratio == pytest.approx(50 / (500 + 1e-5))
    assert row.amt_to_cat_median_ratio == pytest.approx(50 / (500 + 1e-5))
    assert row.category_fraud_rate == 0.5


def test_supplied_columns_pass_through(pair):
    given = pair.withColumns({"amt_to_user_avg_ratio": F.lit(9.0), "trans_velocity_1h": F.lit(5)})
    row = add_features(given, Baselines.fit(pair)).orderBy("trans_num").first()
    assert row.amt_to_user_avg_ratio == 9.0
    assert row.trans_velocity_1h == 0  # recomputed, as only one of the two was there
    both = given.withColumn("trans_velocity_24h", F.lit(6))
    assert add_features(both, Baselines.fit(pair)).first().trans_velocity_1h == 5


def test_missing_birth_date_column(pair):
    ages = add_features(pair.drop("dob"), Baselines.fit(pair)).select("customer_age").distinct().collect()
    assert [r.customer_age for r in ages] == [40.0]


def test_lookup_plans_agree(txns):
    base = Baselines.fit(txns)
    want = base.with_cards(txns).select("trans_num", "card_mean")
    for hot_rows in (5, 10**9):
        spread = lookup_join(txns, base.cards, "cc_num", False, "card_rows", "trans_num", hot_rows).select("trans_num", "card_mean")
        assert spread.count() == txns.count()
        joined = want.join(spread.withColumnRenamed("card_mean", "m"), "trans_num")
        assert joined.where(~F.col("card_mean").eqNullSafe(F.col("m"))).count() == 0


def test_spread_lookup_keeps_unknown_and_null_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k long, id string")
    lookup = spark.createDataFrame([(1, 10.0, 100), (2, 20.0, 1)], "k long, v double, n long")
    got = {r.id: r.v for r in lookup_join(facts, lookup, "k", False, "n", "id", 50).collect()}
    assert got == {"a": 10.0, "b": 10.0, "c": 20.0, "d": None, "e": None}


def test_shuffled_lookups_equal_broadcast_ones(txns):
    small = Baselines.fit(txns)
    large = Baselines.fit(txns, broadcast_rows=3, hot_rows=10)
    assert not large.small_cards
    a = {r.trans_num: r for r in add_features(txns, small).collect()}
    b = {r.trans_num: r for r in add_features(txns, large).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert [float(a[k][f]) for f in FEATURES] == pytest.approx([float(b[k][f]) for f in FEATURES], rel=1e-9)


def test_save_and_load(spark, txns, tmp_path):
    base = Baselines.fit(txns)
    base.save(str(tmp_path))
    loaded = Baselines.load(spark, str(tmp_path))
    assert base.with_cards(txns).select("trans_num", "card_mean").exceptAll(loaded.with_cards(txns).select("trans_num", "card_mean")).count() == 0
