"""Exact stratified split and seeded sampling by hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.config import SPLIT_SEED, SPLIT_SHARES
from riskspark.functions.numeric import half_even

PREFIX = 4  # hex digits of the hash that name a bucket: 65,536 buckets per class


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(f"s{seed}"), F.col(key).cast("string")))


def _allot(sizes: DataFrame, label: str, remaining: str, wanted: str, out: str) -> DataFrame:
    """Largest-remainder share of ``wanted`` rows per class; ties go to the smaller class.
    The table has one row per class, so the windows over all of it stay tiny."""
    everything = W.partitionBy()
    return (
        sizes.withColumn("_exact", F.col(wanted) * F.col(remaining) / F.sum(remaining).over(everything))
        .withColumn("_floor", F.floor("_exact"))
        .withColumn("_missing", F.col(wanted) - F.sum("_floor").over(everything))
        .withColumn("_rest", F.col("_exact") - F.col("_floor"))
        .withColumn("_place", F.row_number().over(everything.orderBy(F.col("_rest").desc(), "n", label)))
        .withColumn(out, (F.col("_floor") + F.when(F.col("_place") <= F.col("_missing"), 1).otherwise(0)).cast("bigint"))
        .drop("_exact", "_floor", "_missing", "_rest", "_place")
    )


def class_cuts(sizes: DataFrame, label: str, shares=SPLIT_SHARES) -> DataFrame:
    """Per class: how many rows end up in train, and in train plus validation."""
    train, val, test = shares
    if abs(train + val + test - 1.0) >= 1e-5:
        raise ValueError("split shares must sum to 1")
    rest = val + test
    sized = (
        sizes.withColumn("_total", F.sum("n").over(W.partitionBy()))
        .withColumn("_held", F.ceil(F.lit(rest) * F.col("_total")))
        .withColumn("_train", F.col("_total") - F.col("_held"))
        .withColumn("_val", F.col("_held") - F.ceil(F.lit(1.0 - val / rest) * F.col("_held")))
    )
    trained = _allot(sized, label, "n", "_train", "cut_train").withColumn("_left", F.col("n") - F.col("cut_train"))
    return _allot(trained, label, "_left", "_val", "_val_rows").select(
        label, "cut_train", (F.col("cut_train") + F.col("_val_rows")).alias("cut_val")
    )


def stratified_split(
    df: DataFrame, label: str = "is_fraud", key: str = "trans_num", seed: int = SPLIT_SEED, shares=SPLIT_SHARES,
) -> DataFrame:
    """Adds ``split`` with exact class counts, without moving the table.

    Rows are ordered by a seeded hash of the key. Bucket counts locate the two
    cut points of each class, only the buckets around a cut are ranked, and the
    hash values found there turn the split into a comparison per row.
    """
    h = hash_order(key, seed)
    ordered = df.select(F.col(label), h.alias("_h"), F.col(key).cast("string").alias("_k"))
    ordered = ordered.withColumn("_bucket", F.substring("_h", 1, PREFIX))
    histogram = ordered.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    cuts = class_cuts(histogram.groupBy(label).agg(F.sum("_rows").alias("n")), label, shares)
    before = W.partitionBy(label).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    around = (
        histogram.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .join(F.broadcast(cuts), label)  # one row per class
        .where(
            ((F.col("cut_train") > F.col("_before")) & (F.col("cut_train") <= F.col("_before") + F.col("_rows")))
            | ((F.col("cut_val") > F.col("_before")) & (F.col("cut_val") <= F.col("_before") + F.col("_rows")))
        )
        .drop("_rows")
    )
    in_bucket = W.partitionBy(label, "_bucket").orderBy("_h", "_k")
    at = F.struct("_h", "_k")
    marks = (
        ordered.join(F.broadcast(around), [label, "_bucket"])  # at most two buckets per class
        .withColumn("_rank", F.col("_before") + F.row_number().over(in_bucket))
        .where((F.col("_rank") == F.col("cut_train")) | (F.col("_rank") == F.col("cut_val")))
        .groupBy(label)
        .agg(
            F.max(F.when(F.col("_rank") == F.col("cut_train"), at)).alias("_last_train"),
            F.max(F.when(F.col("_rank") == F.col("cut_val"), at)).alias("_last_val"),
        )
    )
    here = F.struct(h.alias("_h"), F.col(key).cast("string").alias("_k"))
    split = (
        F.when(F.coalesce(here <= F.col("_last_train"), F.lit(False)), "train")
        .when(F.coalesce(here <= F.col("_last_val"), F.lit(False)), "val")
        .otherwise("test")
    )
    return df.join(F.broadcast(marks), label, "left").withColumn("split", split).drop("_last_train", "_last_val")


def split_summary(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    rows, fraud = F.count(F.lit(1)), F.sum(F.col(label).cast("bigint"))
    return df.groupBy("split").agg(
        rows.alias("total_rows"),
        fraud.alias("fraud_count"),
        (rows - fraud).alias("legit_count"),
        half_even(fraud / rows * 100.0, 2).alias("fraud_percent"),
    )


def seeded_sample(df: DataFrame, n: int, key: str = "trans_num", seed: int = SPLIT_SEED) -> DataFrame:
    """n rows without replacement, the same ones on every run."""
    return df.orderBy(hash_order(key, seed), F.col(key)).limit(n)
