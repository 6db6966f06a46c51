"""Shared inputs of the registered queries, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.config import FROZEN_FUSION, FusionConfig
from riskspark.functions.geo import haversine_km
from riskspark.functions.numeric import half_even
from riskspark.operators.clean import drop_bad_amounts, drop_bad_coordinates
from riskspark.operators.features import Baselines, add_features
from riskspark.operators.fusion import apply_fusion
from riskspark.operators.rules import apply_signals
from riskspark.operators.split import stratified_split
from riskspark.session import shared_folder
from riskspark.sources import store
from riskspark.sources.fixtures import txn, txn_dense, txn_dirty

__all__ = ["txn", "txn_dense", "txn_dirty"]

ROW = ("trans_num", "is_fraud", "amt", "category")


def split_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(drop_bad_coordinates(drop_bad_amounts(txn(spark, sf_dir, parse_once=True))))


def stored_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a written table, for jobs that fit on one split and apply to others."""
    path = shared_folder(spark, "split")
    store.write_splits(split_txn(spark, sf_dir), path)
    return store.read_split(spark, path)


def features(spark: SparkSession, sf_dir: str, velocity: bool = True) -> DataFrame:
    """Features fitted and applied on the same rows."""
    df = txn(spark, sf_dir, parse_once=True)
    return add_features(df, Baselines.fit(df), velocity=velocity)


def surrogate_probability(user_ratio: Column) -> Column:
    """A stand-in probability both engines can compute."""
    return half_even(F.least(F.lit(1.0), user_ratio / 10.0), 6)


def surrogate_anomaly(distance: Column) -> Column:
    return half_even(F.least(F.lit(100.0), distance / 20.0), 6)


def with_surrogates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "p_ml": surrogate_probability(F.col("amt_to_user_avg_ratio")),
            "s_anom": surrogate_anomaly(F.col("haversine_distance_km")),
        }
    )


def probabilities(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    """Surrogate probability and anomaly score; only what they need is computed."""
    df = stored_split(spark, sf_dir) if split else txn(spark, sf_dir, parse_once=True)
    km = haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    fitted = Baselines.fit(df).with_cards(df.withColumn("haversine_distance_km", km))
    ratio = F.col("amt") / (F.col("card_mean") + F.lit(1e-5))
    keep = [*ROW, "p_ml", "s_anom", "haversine_distance_km", "amt_to_user_avg_ratio", *(["split"] if split else [])]
    return with_surrogates(fitted.withColumn("amt_to_user_avg_ratio", ratio)).select(*keep)


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three score sources per row, with the fired signals."""
    return with_surrogates(apply_signals(features(spark, sf_dir)))


def scored(spark: SparkSession, sf_dir: str, cfg: FusionConfig = FROZEN_FUSION) -> DataFrame:
    df = with_surrogates(apply_signals(features(spark, sf_dir), details=False))
    return apply_fusion(df.select(*ROW, "p_ml", "s_anom", "behavioral_score"), cfg)
