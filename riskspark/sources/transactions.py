"""The raw transaction table: schema, readers, column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.calendar import lenient_date, lenient_timestamp
from riskspark.functions.numeric import nan_to_null

# The raw columns, their types and the required subset.
RAW_SCHEMA = """
    trans_date_trans_time STRING, cc_num BIGINT, merchant STRING, category STRING, amt DOUBLE,
    first STRING, last STRING, gender STRING, street STRING, city STRING, state STRING, zip BIGINT,
    lat DOUBLE, long DOUBLE, city_pop BIGINT, job STRING, dob STRING, trans_num STRING,
    unix_time BIGINT, merch_lat DOUBLE, merch_long DOUBLE, is_fraud INT
"""
REQUIRED = (
    "trans_date_trans_time", "cc_num", "merchant", "category", "amt", "lat", "long",
    "merch_lat", "merch_long", "is_fraud",
)
CORRUPT = "corrupt_record"


def missing_columns(df: DataFrame, required=REQUIRED) -> list[str]:
    """Names only; ``trans_ts`` stands in for its text form once parsed."""
    have = set(df.columns) | ({"trans_date_trans_time"} if "trans_ts" in df.columns else set())
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required=REQUIRED) -> DataFrame:
    """Fail while the plan is built, before any data is touched."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"transaction table lacks required columns: {missing}")
    return df


def typed(df: DataFrame) -> DataFrame:
    """Parse the text columns and turn NaN into null, so comparisons behave."""
    out = {}
    if "trans_date_trans_time" in df.columns and "trans_ts" not in df.columns:
        out["trans_ts"] = lenient_timestamp(F.col("trans_date_trans_time"))
    if dict(df.dtypes).get("dob") == "string":
        out["dob"] = lenient_date(F.col("dob"))
    for name, kind in df.dtypes:
        if kind == "double":
            out[name] = nan_to_null(F.col(name))
    return df.withColumns(out) if out else df


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header against the declared schema; broken lines land in ``corrupt_record``."""
    raw = (
        spark.read.schema(f"{RAW_SCHEMA.strip()}, {CORRUPT} STRING")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    return typed(require_columns(raw))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return typed(require_columns(spark.read.parquet(path)))


def column_quality(df: DataFrame, required=REQUIRED) -> DataFrame:
    """One row per contract column: is it there, and how many nulls does it hold (all rows, if it is not there)."""
    present = [c for c in required if c in df.columns]
    absent = [c for c in required if c not in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("present"), F.col(c).alias("null_count")) for c in present],
        *[F.struct(F.lit(c).alias("column_name"), F.lit(False).alias("present"), F.col("_rows").alias("null_count")) for c in absent],
    )
    return counts.select(F.inline(pairs))
