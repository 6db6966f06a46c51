"""Scoring a transaction stream, deduplicating it, and counting tiers over time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.config import FROZEN_FUSION, TIERS, FusionConfig
from riskspark.operators.features import Baselines, add_features
from riskspark.plans.jobs import score_table
from riskspark.streaming.keyed import watermarked, with_velocity

PARTITIONS = "spark.sql.shuffle.partitions"


def read_transactions(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_stream(
    stream: DataFrame, base: Baselines, sources: Callable[[DataFrame], DataFrame], cfg: FusionConfig = FROZEN_FUSION,
    delay: str = "1 hour", **velocity_options,
) -> DataFrame:
    """Velocity from keyed state, then stream-static lookups and pure Columns; ``sources`` adds ``p_ml`` and
    ``s_anom``. A row comes out once the watermark has passed it."""
    counted = with_velocity(stream, delay, **velocity_options)
    featured = add_features(counted, base, velocity=False)
    return score_table(sources(featured), cfg, details=False)


def deduplicated(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per transaction id among those that arrive within ``delay`` of each other."""
    return watermarked(stream, delay).dropDuplicatesWithinWatermark(["trans_num"])


def tier_counts(scored: DataFrame, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows and frauds per time window and tier of a scored stream, by its own watermark; counts are
    combined per task before the shuffle."""
    span = F.window("trans_ts", window, slide) if slide else F.window("trans_ts", window)
    return scored.groupBy(span.alias("window"), "risk_level").agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_count")
    )


def alerts(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("risk_level") == TIERS[2])


def state_partitions(spark: SparkSession) -> int:
    """Twice the cores, or the session's shuffle partitions where these are fewer. A partition of keyed state costs a Python
    worker and a state store per operator and batch, also when it is empty."""
    return min(int(spark.conf.get(PARTITIONS)), 2 * spark.sparkContext.defaultParallelism)


def append_to(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> StreamingQuery:
    """Append to Parquet and stop once the input at hand is used up. A query keeps the number of ``partitions`` of its first start."""
    spark = stream.sparkSession
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(partitions or before))  # the query takes a copy of the session's settings when it starts
    try:
        return (
            stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(PARTITIONS, before)
