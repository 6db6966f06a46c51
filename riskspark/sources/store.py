"""Tables and documents a risk deployment keeps: splits, sweeps, metrics, configs, decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.config import FROZEN_FUSION, LIVE_FUSION


# ---- splits -----------------------------------------------------------------

def write_splits(df: DataFrame, path: str) -> None:
    """One Parquet table, a folder per split, so a split is read by partition pruning."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_or_build_splits(spark: SparkSession, path: str, build) -> DataFrame:
    """Stored splits when the write that made them finished, else ``build()`` and store them."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_splits(build(), path)
    return read_split(spark, path)


# ---- small documents ----------------------------------------------------------

def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_sweep(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_sweep(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


# ---- fusion configs -------------------------------------------------------------

# Keys of a frozen config document, new location first, old flat key second.
CONFIG_KEYS = {
    "w_ml": ("component_weights.ml_weight", "ml_weight", LIVE_FUSION.w_ml),
    "w_anomaly": ("component_weights.anomaly_weight", "anomaly_weight", LIVE_FUSION.w_anomaly),
    "w_rules": ("component_weights.behavioral_weight", "behavioral_weight", LIVE_FUSION.w_rules),
    "low_max": ("risk_thresholds.low_risk_max", "low_risk_threshold", LIVE_FUSION.low_max),
    "medium_max": ("risk_thresholds.medium_risk_max", "medium_risk_threshold", LIVE_FUSION.medium_max),
    "cutoff": ("risk_thresholds.cost_optimal_cutoff", "cost_optimal_cutoff", float(FROZEN_FUSION.cutoff)),
}


def parse_configs(docs: DataFrame, doc: str = "doc", config_id: str = "config_id") -> DataFrame:
    """JSON documents to rows of weights and bounds; each value falls back to the old key, then the default."""
    def pick(new: str, old: str, default: float) -> Column:
        def at(key: str) -> Column:
            return F.get_json_object(F.col(doc), f"$.{key}").try_cast("double")
        return F.coalesce(at(new), at(old), F.lit(default))

    return docs.select(
        F.col(config_id).alias("config_id"),
        *[pick(*where).alias(name) for name, where in CONFIG_KEYS.items()],
    )


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """Every JSON document below ``path`` is one config, named by its file."""
    docs = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.json)?$", 1).alias("config_id"),
        F.col("value").alias("doc"),
    )
    return parse_configs(docs)


# ---- decision log -----------------------------------------------------------------

# The columns of the decision log.
LOG_COLUMNS = (
    "trans_num", "card_masked", "amt", "category", "hybrid_score",
    "risk_level", "fraud_prob", "action", "logged_at",
)


def append_decisions(df: DataFrame, path: str) -> None:
    """Append-only; the tier is a folder, so a tier filter prunes files."""
    df.select(*LOG_COLUMNS).write.mode("append").partitionBy("risk_level").parquet(path)


def search_decisions(log: DataFrame, tier: str | None = None, text: str | None = None) -> DataFrame:
    """Filter by tier and by a piece of the transaction id or category, case-insensitive."""
    conditions = []
    if tier is not None:
        conditions.append(F.col("risk_level") == tier)
    if text:
        needle = F.lit(text.lower())
        conditions.append(
            F.contains(F.lower("trans_num"), needle) | F.contains(F.lower("category"), needle)
        )
    return log.where(reduce(lambda a, b: a & b, conditions)) if conditions else log
