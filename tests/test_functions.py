from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark.functions import calendar, numeric, text
from riskspark.functions.geo import haversine_km


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def km(spark, *degrees):
    return value(spark, haversine_km(*[F.lit(float(d)) for d in degrees]))


def test_distance(spark):
    assert km(spark, 12.97, 77.59, 12.97, 77.59) == 0
    assert 800 < km(spark, 19.0760, 72.8777, 12.9716, 77.5946) < 900
    assert km(spark, 0, 0, 0, 180) == pytest.approx(6371 * 3.141592653589793, rel=1e-9)


def test_half_even_and_clip(spark):
    assert value(spark, numeric.half_even(F.lit(34.5))) == 34
    assert value(spark, numeric.half_even(F.lit(35.5))) == 36
    assert value(spark, numeric.half_even(F.lit(0.125), 2)) == 0.12
    assert value(spark, numeric.clip(F.lit(120.0), 0, 100)) == 100
    assert value(spark, numeric.clip(F.lit(None).cast("double"), 0, 100)) is None
    assert value(spark, numeric.ratio(F.lit(1), F.lit(0))) == 0
    assert value(spark, numeric.fixed(F.lit(0.125), 2)) == "0.12"


def test_calendar(spark):
    ts = F.lit(dt.datetime(2024, 1, 3, 5, 59))  # a Wednesday
    assert value(spark, calendar.monday_weekday(ts)) == 2
    assert value(spark, calendar.is_night(F.hour(ts))) == 1
    assert value(spark, calendar.is_night(F.lit(6))) == 0
    assert value(spark, calendar.age_years(ts, F.lit(dt.date(1989, 12, 31)))) == 35
    assert value(spark, calendar.age_years(ts, F.lit(None).cast("date"))) == 40
    assert value(spark, calendar.age_years(ts, F.lit(dt.date(2020, 1, 1)))) == 18
    assert value(spark, calendar.age_years(ts, F.lit(dt.date(1900, 1, 1)))) == 100
    assert value(spark, calendar.lenient_date(F.lit("not a date"))) is None


def test_wording(spark):
    assert value(spark, text.display_name(F.lit("amt"))) == "Transaction Amount"
    assert value(spark, text.display_name(F.lit("merchant_age_days"))) == "Merchant Age Days"
    up = value(spark, text.feature_sentence(F.lit("haversine_distance_km"), F.lit(1450.0), F.lit(0.4)))
    assert up == "Terminal location is 1450.0 km away from cardholder's home address (elevated fraud risk)."
    down = value(spark, text.feature_sentence(F.lit("hour"), F.lit(14.0), F.lit(-0.1)))
    assert down == "Transaction Hour = 14.00 (reduced risk (protective))."
    night = value(spark, text.feature_sentence(F.lit("is_night_transaction"), F.lit(1.0), F.lit(-0.1)))
    assert night == "Transaction initiated during standard daytime business hours (reduced risk (protective))."
    assert value(spark, text.mask_card(F.lit(4532000011112222))) == "**** **** **** 2222"
    assert value(spark, text.money_text(F.lit(1234.5))) == "$1,234.50"
    assert value(spark, text.percent_text(F.lit(0.986))) == "98.6%"


def test_anomaly_reason(spark):
    quiet = [F.lit(0.0), F.lit(1.0), F.lit(10.0), F.lit(0)]
    assert value(spark, text.anomaly_reason(F.lit(75.0), *quiet)) == text.SEVERE_PLAIN
    assert value(spark, text.anomaly_reason(F.lit(40.0), *quiet)) == text.MILD
    assert value(spark, text.anomaly_reason(F.lit(39.9), *quiet)) == text.ROUTINE
    loud = value(spark, text.anomaly_reason(F.lit(70.0), F.lit(450.6), F.lit(3.14), F.lit(600.0), F.lit(1)))
    assert loud.endswith(
        "large geographical jump (451 km), atypical spending surge (3.1x user average), "
        "abnormally large order value ($600.00), late-night authorization."
    )
