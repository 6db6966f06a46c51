"""Leakage audit: id overlap, label correlation, fit isolation, look-ahead, prevalence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.config import FEATURES, LEAKAGE_CORRELATION
from riskspark.functions.numeric import half_even
from riskspark.operators.profile import label_correlations
from riskspark.operators.velocity import velocity_violations

PAIRS = (("train", "val"), ("train", "test"), ("val", "test"))


def split_sets(df: DataFrame, key: str = "trans_num") -> DataFrame:
    """Which splits each id occurs in (at most three values per id)."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set("split")).alias("splits"))


def shared_ids(df: DataFrame, key: str = "trans_num") -> DataFrame:
    """Ids in more than one split."""
    return split_sets(df, key).where(F.size("splits") > 1)


def id_overlap(df: DataFrame, key: str = "trans_num") -> DataFrame:
    """Number of shared ids per pair of splits."""
    both = lambda a, b: F.array_contains("splits", a) & F.array_contains("splits", b)
    return split_sets(df, key).agg(*[F.count_if(both(a, b)).alias(f"{a}_{b}_overlap") for a, b in PAIRS])


def suspicious_features(df: DataFrame, features: Sequence[str] = FEATURES, limit: float = LEAKAGE_CORRELATION) -> DataFrame:
    return label_correlations(df, features).withColumn("suspicious", F.coalesce(F.abs("correlation") > limit, F.lit(False)))


def fit_isolation(train: DataFrame, globals_: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """The fitted global mean must be the mean of the training rows."""
    learned = globals_.select("global_mean").scalar()
    row = train.agg(F.avg("amt").alias("_expected")).withColumn("_learned", learned)
    gap = F.abs(F.col("_expected") - F.col("_learned"))
    return row.select(
        half_even(F.col("_expected"), 4).alias("expected_train_mean"), half_even(F.col("_learned"), 4).alias("learned_mean"),
        half_even(gap, 6).alias("difference"), (gap < tolerance).alias("passed"),
    )


def prevalence(df: DataFrame, limit_pct: float = 5.0, gap_pct: float = 0.2) -> DataFrame:
    """The test split keeps the natural imbalance of the train split."""
    rate = lambda s: F.avg(F.when(F.col("split") == s, F.col("is_fraud"))) * 100.0
    row = df.agg(rate("test").alias("_test"), rate("train").alias("_train"))
    ok = (F.col("_test") < limit_pct) & (F.abs(F.col("_test") - F.col("_train")) < gap_pct)
    return row.select(
        half_even(F.col("_test"), 2).alias("test_fraud_rate_percent"),
        half_even(F.col("_train"), 2).alias("train_fraud_rate_percent"), ok.alias("passed"),
    )


def audit_report(df: DataFrame, train_features: DataFrame, globals_: DataFrame, cutoff: Column) -> DataFrame:
    """One row per check, plus the overall verdict."""
    def check(name: str, frame: DataFrame, passed: Column) -> DataFrame:
        return frame.select(F.lit(name).alias("check_name"), passed.alias("passed"))

    overlap = id_overlap(df)
    nothing_shared = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in overlap.columns])
    suspects = suspicious_features(train_features).agg(F.count_if("suspicious").alias("_n"))
    look_ahead = velocity_violations(df, cutoff, scope=())
    checks = [
        check("cross_split_id_overlap", overlap, nothing_shared),
        check("target_feature_correlation", suspects, F.col("_n") == 0),
        check("preprocessor_partition_isolation", fit_isolation(df.where(F.col("split") == "train"), globals_), F.col("passed")),
        check("temporal_velocity_direction", look_ahead, (F.col("nonzero_first") == 0) & (F.col("changed_rows") == 0)),
        check("test_set_distribution_authenticity", prevalence(df), F.col("passed")),
    ]
    rows = reduce(lambda a, b: a.unionByName(b), checks)
    overall = rows.groupBy(F.lit("overall_audit_passed").alias("check_name")).agg(F.bool_and("passed").alias("passed"))
    return rows.unionByName(overall)
