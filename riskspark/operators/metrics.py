"""Model evaluation: metrics at a cut-off, benchmarks over weight sets, ablation, error samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.config import OVERFIT_GAP, WITHOUT_OPERATIONS, CostConfig
from riskspark.functions.numeric import half_even, percent, ratio
from riskspark.operators.cost import CELLS, confusion, costs, rates
from riskspark.operators.curves import curve_areas


def comprehensive_metrics(df: DataFrame, flagged: Column, score: Column, model: str, by: Sequence[str] = ()) -> DataFrame:
    """Sizes, confusion, rates and areas per group."""
    by = list(by)
    base = confusion(df, flagged, amount=None, by=by)
    area = curve_areas(df, score, by=by)
    joined = base.join(area, by) if by else base.withColumn("_a", area.select(F.struct("*")).scalar()).select("*", "_a.*").drop("_a")
    return joined.select(*by, *metric_columns(model))


def metric_columns(model: str) -> list[Column]:
    """Sizes, rates and areas from confusion counts and areas."""
    r = rates()
    fraud = F.col("tp") + F.col("fn")
    total = fraud + F.col("fp") + F.col("tn")
    return [
        F.lit(model).alias("model_name"), total.alias("sample_size"), fraud.alias("fraud_count"),
        (total - fraud).alias("legitimate_count"), half_even(ratio(fraud, total) * 100.0, 2).alias("fraud_rate_percent"),
        r["precision"].alias("precision"), r["recall"].alias("recall"), r["f1"].alias("f1_score"), r["f2"].alias("f2_score"),
        "pr_auc", "roc_auc", r["fpr"].alias("false_positive_rate"), *map(F.col, CELLS),
    ]


def metrics_at(df: DataFrame, score: str, threshold: float, cfg: CostConfig = WITHOUT_OPERATIONS, by: Sequence[str] = ()) -> DataFrame:
    """Rates and costs at one threshold."""
    wanted = {n: c for n, c in rates().items() if n in ("precision", "recall", "f1", "f2", "fpr")}
    out = confusion(df, F.col(score) >= threshold, by=by).withColumns({**wanted, **costs(cfg)})
    return out.withColumn("threshold", F.lit(float(threshold))).drop(*[f"{c}_amt" for c in CELLS])


def error_rates(df: DataFrame, flagged: Column) -> DataFrame:
    r = rates()
    return confusion(df, flagged, amount=None).select(
        *CELLS, r["accuracy"].alias("accuracy"), r["specificity"].alias("specificity"),
        r["fpr"].alias("false_positive_rate"), r["fnr"].alias("false_negative_rate"),
    )


def benchmark_configs(df: DataFrame, score: str = "hybrid_score", cutoff: int = 50, config: str = "config") -> DataFrame:
    """PR-AUC, rates at ``cutoff`` and cost for every weight set present in ``config``."""
    area = curve_areas(df, F.col(score) / 100.0, by=(config,), digits=5).drop("roc_auc")
    return metrics_at(df, score, cutoff, by=(config,)).join(area, config).select(
        config, "pr_auc", "precision", "recall", "f1", "total_cost"
    )


def select_config(benchmark: DataFrame, config: str = "config", order: Sequence[str] = ()) -> DataFrame:
    """Least cost wins; among equals the last one in ``order`` (else by name) whose PR-AUC is at least 0.999, else the first."""
    place = F.array_position(F.array(*[F.lit(name) for name in order]), F.col(config)) if order else F.col(config)
    tied = F.min("total_cost").over(W.partitionBy()) == F.col("total_cost")  # a handful of weight sets
    best = benchmark.where(F.col("total_cost").isNotNull()).withColumn("_tied", tied).where("_tied")
    late = F.max_by(config, F.when(F.col("pr_auc") >= 0.999, place))
    return best.agg(F.coalesce(late, F.min_by(config, place)).alias(config), F.min("total_cost").alias("total_cost"))


def best_of(areas: DataFrame, config: str = "config") -> DataFrame:
    """The weight set of greatest PR-AUC; the first one wins a tie."""
    best = F.max_by(F.struct(config, "pr_auc"), F.struct(F.col("pr_auc"), -F.col(config)))
    return areas.agg(best.alias("_b")).select("_b.*")


def best_weights(df: DataFrame, score: Column, config: str = "config") -> DataFrame:
    """The best of the weight sets that the rows carry."""
    return best_of(curve_areas(df, score, by=(config,), digits=9), config)


def ablation(df: DataFrame, variants: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Several scores of the same rows, each with its own decision (``name: (score 0-1, flagged)``), compared."""
    rows = F.array(*[
        F.struct(F.lit(n).alias("model"), s.cast("double").alias("_score"), f.cast("boolean").alias("_flag"))
        for n, (s, f) in variants.items()
    ])
    long = df.select("is_fraud", "amt", F.inline(rows))
    area = curve_areas(long, F.col("_score"), by=("model",)).drop("roc_auc")
    wanted = {n: c for n, c in rates().items() if n in ("precision", "recall", "f1")}
    found = confusion(long, F.col("_flag"), by=("model",)).withColumns({**wanted, **costs(WITHOUT_OPERATIONS)})
    return found.join(area, "model").select("model", "precision", "recall", "f1", "pr_auc", "fp", "fn", "total_cost")


def model_comparison(results: dict[str, DataFrame]) -> DataFrame:
    """Metric rows of several models, one table."""
    named = [df.withColumn("model", F.lit(name)) for name, df in results.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def overfit_gap(df: DataFrame, score: str, threshold: float = 0.5, limit: float = OVERFIT_GAP) -> DataFrame:
    """Train against validation: PR-AUC and F1, their gaps, and whether both stay below the limit."""
    both = df.where(F.col("split").isin("train", "val"))
    area = curve_areas(both, F.col(score), by=("split",), digits=None).select("split", "pr_auc")
    f1 = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    per = confusion(both, F.col(score) >= threshold, amount=None, by=("split",)).withColumn("f1", f1).join(area, "split")
    at = lambda c, s: F.max(F.when(F.col("split") == s, F.col(c)))
    row = per.agg(*[at(c, s).alias(f"{s}_{c}") for c in ("pr_auc", "f1") for s in ("train", "val")])
    gap_pr, gap_f1 = F.abs(F.col("train_pr_auc") - F.col("val_pr_auc")), F.abs(F.col("train_f1") - F.col("val_f1"))
    return row.select(
        *[half_even(F.col(f"{s}_{c}"), 4).alias(f"{s}_{c}") for c in ("pr_auc", "f1") for s in ("train", "val")],
        half_even(gap_pr, 4).alias("gap_pr_auc"), half_even(gap_f1, 4).alias("gap_f1"),
        ((gap_pr < limit) & (gap_f1 < limit)).alias("generalizes"),
    )


def anomaly_diagnostics(df: DataFrame, flag: Column) -> DataFrame:
    """How the unsupervised flag lines up with the known label."""
    row = confusion(df, flag, amount=None)
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return row.select(
        total.alias("total_rows"), (F.col("tp") + F.col("fp")).alias("anomalies"),
        half_even(percent(F.col("tp") + F.col("fp"), total), 2).alias("anomaly_pct"),
        F.col("tp").alias("fraud_flagged"), F.col("fn").alias("fraud_missed"), F.col("fp").alias("legit_flagged"),
        half_even(percent(F.col("tp"), F.col("tp") + F.col("fn")), 2).alias("recall_pct"),
        half_even(percent(F.col("tp"), F.col("tp") + F.col("fp")), 2).alias("precision_pct"),
    )


def outcome(label: Column, flagged: Column) -> Column:
    return (
        F.when((label == 1) & flagged, "tp").when((label == 0) & flagged, "fp").when((label == 1) & ~flagged, "fn").otherwise("tn")
    )


def error_samples(df: DataFrame, flagged: Column, k: int = 2, key: str = "trans_num") -> DataFrame:
    """The first k false positives and k false negatives by key. Ranking below k is cut per task
    before the shuffle, so the size of a class does not matter."""
    first = W.partitionBy("outcome").orderBy(key)
    return (
        df.withColumn("outcome", outcome(F.col("is_fraud"), flagged))
        .where(F.col("outcome").isin("fp", "fn"))
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= k)
    )


def ranked(df: DataFrame, by: str, name: str) -> DataFrame:
    """A short table ranked by a value, greatest first (feature lists, not data)."""
    return df.withColumn("place", F.row_number().over(W.partitionBy().orderBy(F.col(by).desc(), name)))
