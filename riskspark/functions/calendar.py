"""Hour, weekday, night flag, age and lenient dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.functions.numeric import clip

NIGHT_FROM, NIGHT_TO = 0, 5  # inclusive hours
DEFAULT_AGE, MIN_AGE, MAX_AGE = 40.0, 18.0, 100.0


def is_night(hour: Column) -> Column:
    return F.when(hour.between(NIGHT_FROM, NIGHT_TO), 1).otherwise(0)


def monday_weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def age_years(ts: Column, dob: Column) -> Column:
    """Difference of calendar years; unknown birth dates count as 40, bounds 18 to 100."""
    years = (F.year(ts) - F.year(dob)).cast("double")
    return clip(F.coalesce(years, F.lit(DEFAULT_AGE)), MIN_AGE, MAX_AGE)


def lenient_date(text: Column) -> Column:
    """Unparseable text becomes null instead of failing the job."""
    return text.try_cast("date")


def lenient_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")
