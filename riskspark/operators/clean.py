"""Cleaning: first-wins dedup, range filters, imputation, label check, drop log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.calendar import is_night
from riskspark.functions.numeric import nan_to_null
from riskspark.functions.text import mask_card
from riskspark.operators.quantiles import medians

# Columns that are filled.
MEDIAN_COLUMNS = ("lat", "long", "merch_lat", "merch_long", "city_pop")
TEXT_COLUMNS = ("merchant", "category", "gender", "job", "state", "city")
UNKNOWN = "UNKNOWN"

# Coordinates used when a request names none.
HOME_LAT, HOME_LON, KM_PER_DEGREE = 32.7767, -96.7970, 111.0


def keep_first(df: DataFrame, key: str = "trans_num", order: tuple[str, ...] = ()) -> DataFrame:
    """The first row per key in ingest order; equal keys meet as partial minima, never as a group."""
    if key not in df.columns:
        return df.dropDuplicates()
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[F.col(c) for c in order]) if order else row
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(row, rank).alias("_row")).select("_row.*")


def bad_amount() -> Column:
    return F.coalesce(nan_to_null(F.col("amt").cast("double")) <= 0, F.lit(True))


def bad_coordinates() -> Column:
    """Out of range; an unknown coordinate is not out of range."""
    def outside(name: str, limit: float) -> Column:
        return F.coalesce(F.abs(nan_to_null(F.col(name).cast("double"))) > limit, F.lit(False))
    return outside("lat", 90.0) | outside("long", 180.0) | outside("merch_lat", 90.0) | outside("merch_long", 180.0)


def drop_bad_amounts(df: DataFrame) -> DataFrame:
    return df.where(~bad_amount())


def drop_bad_coordinates(df: DataFrame) -> DataFrame:
    return df.where(~bad_coordinates())


def impute_medians(df: DataFrame, columns=MEDIAN_COLUMNS) -> DataFrame:
    """Fill numeric gaps with the exact median of the rows at hand."""
    present = [c for c in columns if c in df.columns]
    row = medians(df, present).select(F.struct(*present)).scalar()
    filled = {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.col("_median")[c]) for c in present}
    return df.withColumn("_median", row).withColumns(filled).drop("_median")


def impute_unknown(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    return df.fillna(UNKNOWN, subset=[c for c in columns if c in df.columns])


def label_domain_violations(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Count of labels outside {0, 1}; a null label is a violation too."""
    ok = F.coalesce(F.col(label).cast("int").isin(0, 1), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("violations"))


def standardize_label(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Cast to int; a label outside {0, 1} fails the job where it is read."""
    value = F.col(label).cast("int")
    ok = F.coalesce(value.isin(0, 1), F.lit(False))
    return df.withColumn(label, F.when(ok, value).otherwise(F.raise_error(F.lit(f"{label} must be 0 or 1")).cast("int")))


def clean(df: DataFrame, key: str = "trans_num", order: tuple[str, ...] = ()) -> DataFrame:
    """Dedup, drop, impute and standardize in that order."""
    kept = drop_bad_coordinates(drop_bad_amounts(keep_first(df, key, order)))
    return standardize_label(impute_unknown(impute_medians(kept)))


def cleaning_log(df: DataFrame, key: str = "trans_num", order: tuple[str, ...] = ()) -> DataFrame:
    """Rows in, rows dropped by their first reason, rows out."""
    reason = F.when(bad_amount(), "amount").when(bad_coordinates(), "coordinates").otherwise("kept")
    first = keep_first(df, key, order).groupBy(reason.alias("reason")).count()
    n = lambda r: F.coalesce(F.sum(F.when(F.col("reason") == r, F.col("count"))), F.lit(0))
    survivors = first.agg(
        n("amount").alias("invalid_amounts_removed"),
        n("coordinates").alias("invalid_coords_removed"),
        n("kept").alias("final_row_count"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("_unique"),
    )
    initial = df.agg(F.count(F.lit(1))).scalar()
    return survivors.withColumn("initial_row_count", initial).select(
        (F.col("initial_row_count") - F.col("_unique")).alias("duplicates_removed"),
        "invalid_amounts_removed",
        "invalid_coords_removed",
        "initial_row_count",
        "final_row_count",
        (F.col("initial_row_count") - F.col("final_row_count")).alias("total_records_dropped"),
    )


# ---- request rows ---------------------------------------------------------------

# Allowed ranges of a scoring request (name, lower, inclusive, upper).
REQUEST_RANGES = (
    ("amt", 0.0, False, None),
    ("hour", 0.0, True, 23.0),
    ("day_of_week", 0.0, True, 6.0),
    ("customer_age", 18.0, True, 100.0),
    ("haversine_distance_km", 0.0, True, None),
    ("amt_to_user_avg_ratio", 0.0, False, None),
    ("amt_to_cat_median_ratio", 0.0, False, None),
    ("trans_velocity_1h", 0.0, True, None),
    ("trans_velocity_24h", 0.0, True, None),
)


def validate_requests(df: DataFrame) -> DataFrame:
    """Adds ``is_valid`` and the names of the violated ranges; columns not sent are not checked."""
    broken = []
    for name, low, inclusive, high in REQUEST_RANGES:
        if name in df.columns:
            c = F.col(name)
            ok = (c >= low) if inclusive else (c > low)
            if high is not None:
                ok = ok & (c <= high)
            broken.append(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)))
    violations = F.array_compact(F.array(*broken))
    return df.withColumn("violations", violations).withColumn("is_valid", F.size("violations") == 0)


def infer_night_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_night_transaction", F.coalesce(F.col("is_night_transaction"), is_night(F.col("hour"))))


def fill_coordinates(df: DataFrame, distance: str = "haversine_distance_km") -> DataFrame:
    """Missing coordinates: a fixed home, and a merchant due north at the stated distance."""
    km = F.coalesce(F.col(distance), F.lit(5.0))
    defaults = {
        "lat": F.lit(HOME_LAT),
        "long": F.lit(HOME_LON),
        "merch_lat": F.lit(HOME_LAT) + km / KM_PER_DEGREE,
        "merch_long": F.lit(HOME_LON),
    }
    return df.withColumns(
        {c: F.coalesce(F.col(c), d) if c in df.columns else d for c, d in defaults.items()}
    )


def mask_cards(df: DataFrame, card: str = "cc_num") -> DataFrame:
    return df.withColumn("card_masked", mask_card(F.col(card))).drop(card)
