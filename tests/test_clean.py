from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskspark.operators import clean as C
from riskspark.operators.quantiles import medians
from riskspark.sources import store, transactions

SCHEMA = "trans_num string, seq int, amt double, lat double, long double, merch_lat double, merch_long double, category string, is_fraud int"


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("a", 1, 10.0, 1.0, 1.0, 1.0, 1.0, "x", 0),
        ("a", 2, 99.0, 1.0, 1.0, 1.0, 1.0, "x", 1),  # later copy of a
        ("b", 3, 0.0, 1.0, 1.0, 1.0, 1.0, "x", 0),  # no amount
        ("c", 4, None, 1.0, 1.0, 1.0, 1.0, "x", 0),
        ("d", 5, 20.0, 91.0, 1.0, 1.0, 1.0, "x", 0),  # out of range
        ("e", 6, 30.0, None, 1.0, 3.0, 1.0, None, 1),  # unknown, not invalid
        ("f", 7, 40.0, 5.0, -180.0, 5.0, 180.0, "y", 0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_first_row_wins(raw):
    kept = {r.trans_num: r.amt for r in C.keep_first(raw, order=("seq",)).collect()}
    assert kept["a"] == 10.0 and len(kept) == 6
    last = {r.trans_num: r.amt for r in C.keep_first(raw.withColumn("seq", -F.col("seq")), order=("seq",)).collect()}
    assert last["a"] == 99.0


def test_dedup_without_key_uses_whole_rows(raw):
    nameless = raw.drop("trans_num", "seq")
    assert C.keep_first(nameless.unionByName(nameless)).count() == nameless.distinct().count()


def test_clean_and_log(raw):
    out = {r.trans_num: r for r in C.clean(raw, order=("seq",)).collect()}
    assert set(out) == {"a", "e", "f"}
    assert out["e"].lat == 3.0  # median of 1 and 5, the surviving rows
    assert out["e"].category == C.UNKNOWN
    log = C.cleaning_log(raw, order=("seq",)).first().asDict()
    assert log == {
        "duplicates_removed": 1, "invalid_amounts_removed": 2, "invalid_coords_removed": 1,
        "initial_row_count": 7, "final_row_count": 3, "total_records_dropped": 4,
    }


def test_medians_agree_with_the_built_in(raw):
    columns = ["amt", "lat", "merch_lat"]
    assert medians(raw, columns).first() == raw.agg(*[F.percentile(c, 0.5).alias(c) for c in columns]).first()


def test_nan_is_a_gap(spark, raw):
    bad = raw.withColumn("lat", F.when(F.col("trans_num") == "e", float("nan")).otherwise(F.col("lat")))
    assert {r.trans_num: r.lat for r in C.impute_medians(bad).collect()}["e"] == medians(bad, ["lat"]).first().lat


def test_labels(spark, raw):
    assert C.label_domain_violations(raw).first().violations == 0
    bad = raw.withColumn("is_fraud", F.lit(2))
    assert C.label_domain_violations(bad).first().violations == 7
    with pytest.raises(Exception, match="must be 0 or 1"):
        C.standardize_label(bad).collect()


def test_contract(raw):
    with pytest.raises(ValueError, match="trans_date_trans_time"):
        transactions.require_columns(raw)
    quality = {r.column_name: r for r in transactions.column_quality(raw).collect()}
    assert quality["amt"].null_count == 1 and not quality["cc_num"].present


def test_requests(spark):
    df = spark.createDataFrame([(1.0, 23, 18.0), (0.0, 24, 17.0), (None, 0, 100.0)], "amt double, hour int, customer_age double")
    got = [(r.is_valid, r.violations) for r in C.validate_requests(df).collect()]
    assert got == [(True, []), (False, ["amt", "hour", "customer_age"]), (False, ["amt"])]


def test_coordinates_are_filled(spark):
    df = spark.createDataFrame([(111.0, None), (None, 7.0)], "haversine_distance_km double, lat double")
    rows = C.fill_coordinates(df).collect()
    assert rows[0].lat == C.HOME_LAT and rows[0].merch_lat == pytest.approx(C.HOME_LAT + 1)
    assert rows[1].lat == 7.0 and rows[1].merch_lat == pytest.approx(C.HOME_LAT + 5 / 111)


def test_configs_fall_back(spark):
    docs = [
        ("new", '{"component_weights": {"ml_weight": 0.5}, "ml_weight": 0.9, "risk_thresholds": {"low_risk_max": 30}}'),
        ("old", '{"ml_weight": 0.9, "medium_risk_threshold": 60}'),
        ("none", "{}"),
    ]
    rows = {r.config_id: r for r in store.parse_configs(spark.createDataFrame(docs, "config_id string, doc string")).collect()}
    assert (rows["new"].w_ml, rows["new"].low_max) == (0.5, 30.0)
    assert (rows["old"].w_ml, rows["old"].medium_max) == (0.9, 60.0)
    assert (rows["none"].w_ml, rows["none"].w_anomaly, rows["none"].w_rules, rows["none"].low_max) == (0.65, 0.20, 0.15, 35.0)


def test_csv_reader_keeps_broken_lines(spark, tmp_path):
    names = [f.split()[0] for f in transactions.RAW_SCHEMA.replace("\n", " ").split(",")]
    good = ["2024-01-01 10:00:00", "1", "m", "c", "5.5", *["x"] * 6, "1", "1.0", "2.0", "3", "j", "1980-01-01", "t1", "0", "1.0", "2.0", "0"]
    bad = list(good)
    bad[4], bad[17] = "much", "t2"
    (tmp_path / "t.csv").write_text("\n".join(",".join(line) for line in (names, good, bad)))
    rows = {r.trans_num: r for r in transactions.read_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert rows["t1"].amt == 5.5 and rows["t1"].dob.year == 1980 and rows["t1"].corrupt_record is None
    assert rows["t2"].amt is None and rows["t2"].corrupt_record is not None
