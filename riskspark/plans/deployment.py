"""A deployment: classifier, forest, baselines and fusion settings kept together, and requests answered by it."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.config import FROZEN_FUSION, FusionConfig
from riskspark.ml.attribution import explain
from riskspark.ml.iforest import IsolationForest
from riskspark.ml.supervised import FraudModel
from riskspark.operators.clean import validate_requests
from riskspark.operators.features import Baselines, add_features
from riskspark.plans.jobs import explain_table, request_table, score_with_models

# What a request that leaves a field out stands for.
REQUEST_DEFAULTS = {
    "trans_num": ("string", "TXN_LIVE"), "cc_num": ("bigint", 4532000011112222), "category": ("string", "grocery_pos"), "hour": ("int", 14),
    "day_of_week": ("int", 2), "customer_age": ("double", 35.0), "haversine_distance_km": ("double", 5.0), "amt_to_user_avg_ratio": ("double", 1.0),
    "amt_to_cat_median_ratio": ("double", 1.0), "trans_velocity_1h": ("int", 0), "trans_velocity_24h": ("int", 1), "is_night_transaction": ("int", None),
}
VERSIONS = "version int, name string, fusion string"
FUSION_FIELDS = "config_id string, w_ml double, w_anomaly double, w_rules double, low_max double, medium_max double, cutoff int, actions array<string>"


@dataclass
class Deployment:
    model: FraudModel
    forest: IsolationForest
    baselines: Baselines
    fusion: FusionConfig = FROZEN_FUSION

    # -- storage -----------------------------------------------------------------

    def save(self, spark: SparkSession, root: str, version: int) -> None:
        """Everything below ``root/v<version>``. The row of the version table comes last, so a version that is listed is whole."""
        at = f"{root}/v{version}"
        self.model.save(f"{at}/model")
        self.forest.save(spark, f"{at}/forest")
        self.baselines.save(f"{at}/baselines")
        fields = asdict(self.fusion)
        settings = spark.createDataFrame([{**fields, "actions": list(fields["actions"])}], FUSION_FIELDS).select(F.to_json(F.struct("*")).alias("fusion"))
        row = settings.select(F.lit(version).alias("version"), F.lit(self.model.name).alias("name"), "fusion")
        row.write.mode("append").parquet(f"{root}/versions")

    @classmethod
    def load(cls, spark: SparkSession, root: str, version: int | None = None) -> "Deployment":
        """The named version, or the newest one."""
        listed = spark.read.schema(VERSIONS).parquet(f"{root}/versions")
        wanted = listed if version is None else listed.where(F.col("version") == version)
        row = wanted.orderBy(F.col("version").desc()).first()
        if row is None:
            raise ValueError(f"no version {version} below {root}")
        kept = wanted.where(F.col("version") == row["version"]).select(F.from_json("fusion", FUSION_FIELDS).alias("f")).first()["f"].asDict()
        at = f"{root}/v{row['version']}"
        return cls(
            FraudModel.load(row["name"], f"{at}/model"), IsolationForest.load(spark, f"{at}/forest"), Baselines.load(spark, f"{at}/baselines"),
            FusionConfig(**{**kept, "actions": tuple(kept["actions"])}))

    # -- use -----------------------------------------------------------------------

    def scored(self, featured: DataFrame) -> DataFrame:
        return score_with_models(featured, self.model, self.forest, self.fusion)

    def attributed(self, featured: DataFrame) -> DataFrame:
        """Scored rows with the contribution of every feature."""
        return explain(self.model, self.scored(featured))

    def explained(self, featured: DataFrame) -> DataFrame:
        return explain_table(self.attributed(featured), self.fusion)

    def request_features(self, accepted: DataFrame) -> DataFrame:
        """Features of valid requests; stated ratios and velocities stand, rates come from the baselines."""
        return add_features(request_table(accepted), self.baselines, velocity=False)


def with_defaults(requests: DataFrame) -> DataFrame:
    """Fields left out, as a column or in a row, take their defaults; an amount has none."""
    out = requests
    for name, (kind, value) in REQUEST_DEFAULTS.items():
        default = F.lit(value).cast(kind)
        out = out.withColumn(name, F.coalesce(F.col(name).cast(kind), default) if name in requests.columns else default)
    return out


def checked_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): a request outside the allowed ranges keeps the names of what it violates."""
    checked = validate_requests(with_defaults(requests))
    accepted = checked.where("is_valid").drop("violations", "is_valid")
    return accepted, checked.where(~F.col("is_valid")).drop("is_valid")


def answer_requests(requests: DataFrame, deployment: Deployment) -> tuple[DataFrame, DataFrame]:
    """(explanations of the accepted requests, quarantined requests), each one plan over the request table."""
    accepted, quarantined = checked_requests(requests)
    return deployment.explained(deployment.request_features(accepted)), quarantined
