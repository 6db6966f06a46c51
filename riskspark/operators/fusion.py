"""Fusing probability, anomaly and behaviour into a 0-100 score, a tier and reasons."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.config import ANOMALY_CUTOFF, FROZEN_FUSION, TIERS, UNIT_FUSION, FusionConfig
from riskspark.functions.numeric import clip, fixed, half_even
from riskspark.operators.curves import ROWS_PER_TASK, areas, sliced_counts
from riskspark.session import stored

SOURCE_ROWS = 8 * ROWS_PER_TASK  # that a task makes of its sources and weight sets; it sorts them by task in memory


def normalized(w_ml: Column, w_anomaly: Column, w_rules: Column) -> tuple[Column, Column, Column]:
    total = w_ml + w_anomaly + w_rules
    return w_ml / total, w_anomaly / total, w_rules / total


def config_weights(cfg: FusionConfig) -> tuple[Column, Column, Column]:
    total = cfg.w_ml + cfg.w_anomaly + cfg.w_rules
    return F.lit(cfg.w_ml / total), F.lit(cfg.w_anomaly / total), F.lit(cfg.w_rules / total)


def to_score(raw: Column) -> Column:
    return clip(half_even(raw), 0.0, 100.0).cast("int")


def fuse(p: Column, anomaly: Column, behaviour: Column, weights: tuple[Column, Column, Column]) -> Column:
    """Probability 0-1, the two scores 0-100."""
    w_ml, w_anomaly, w_rules = weights
    return to_score(w_ml * (p * 100.0) + w_anomaly * anomaly + w_rules * behaviour)


def fuse_unit(p: Column, anomaly: Column, rules: Column, weights: tuple[Column, Column, Column]) -> Column:
    """All three inputs 0-1."""
    w_ml, w_anomaly, w_rules = weights
    return to_score((w_ml * p + w_anomaly * anomaly + w_rules * rules) * 100.0)


def tier(score: Column, low_max: Column, medium_max: Column) -> Column:
    return F.when(score <= low_max, TIERS[0]).when(score <= medium_max, TIERS[1]).otherwise(TIERS[2])


def action(score: Column, cfg: FusionConfig) -> Column:
    low, medium, high = cfg.actions
    return F.when(score <= cfg.low_max, low).when(score <= cfg.medium_max, medium).otherwise(high)


def apply_fusion(
    df: DataFrame, cfg: FusionConfig = FROZEN_FUSION, p: str = "p_ml", anomaly: str = "s_anom", behaviour: str = "behavioral_score"
) -> DataFrame:
    """Adds ``hybrid_score``, ``risk_level`` and ``recommended_action`` under one preset."""
    blend = fuse_unit if cfg.config_id == UNIT_FUSION.config_id else fuse
    out = df.withColumn("hybrid_score", blend(F.col(p), F.col(anomaly), F.col(behaviour), config_weights(cfg)))
    return out.withColumns(
        {
            "risk_level": tier(F.col("hybrid_score"), F.lit(cfg.low_max), F.lit(cfg.medium_max)),
            "recommended_action": action(F.col("hybrid_score"), cfg),
        }
    )


def apply_config_table(
    df: DataFrame, configs: DataFrame, p: str = "p_ml", anomaly: str = "s_anom", behaviour: str = "behavioral_score"
) -> DataFrame:
    """Score every row under every config of a config table in one job. The table (a handful of
    documents) reaches the rows as one array value."""
    rows = configs.agg(F.array_sort(F.collect_list(F.struct(*configs.columns)))).scalar()
    out = df.select("*", F.inline(rows))
    weights = normalized(F.col("w_ml"), F.col("w_anomaly"), F.col("w_rules"))
    out = out.withColumn("hybrid_score", fuse(F.col(p), F.col(anomaly), F.col(behaviour), weights))
    return out.withColumn("risk_level", tier(F.col("hybrid_score"), F.col("low_max"), F.col("medium_max")))


def with_weight_sets(df: DataFrame, sets: Iterable[tuple]) -> DataFrame:
    """Each row once per weight set (``config``, ``w_ml``, ``w_anomaly``, ``w_rules``)."""
    grid = F.array(*[
        F.struct(F.lit(name).alias("config"), F.lit(a).alias("w_ml"), F.lit(b).alias("w_anomaly"), F.lit(c).alias("w_rules"))
        for name, a, b, c in sets
    ])
    return df.select("*", F.inline(grid))


def source_counts(df: DataFrame, sources: Sequence[str], label: str = "is_fraud") -> DataFrame:
    """Distinct score sources with their positives and negatives, written: what a grid of weight sets needs of the rows."""
    pos = (F.col(label) == 1).cast("bigint")
    return stored(df.groupBy(*sources).agg(F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg")), "sources")


def grid_areas(df: DataFrame, sets: Iterable[tuple], mix: Column, sources: Sequence[str], label: str = "is_fraud", digits: int | None = 6) -> DataFrame:
    """PR-AUC and ROC-AUC of every weight set in one sliced pass over the distinct sources, dealt to tasks that
    can hold what the sets make of them."""
    sets = list(sets)
    counts = source_counts(df, sources, label)
    rows = counts.count() * len(sets)
    dealt = counts.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // SOURCE_ROWS)), *sources)
    moved = sliced_counts(with_weight_sets(dealt, sets), mix, F.col("pos"), F.col("neg"), ("config",), rows)
    return areas(moved, by=("config",), digits=digits)


def score_breakdown(
    df: DataFrame, cfg: FusionConfig = FROZEN_FUSION, p: str = "p_ml", anomaly: str = "s_anom", behaviour: str = "behavioral_score"
) -> DataFrame:
    """Adds the signed parts of the fused score; their sum, rounded, is the score."""
    w_ml, w_anomaly, w_rules = config_weights(cfg)
    parts = {"ml": (w_ml, F.col(p) * 100.0), "anomaly": (w_anomaly, F.col(anomaly)), "behavioral": (w_rules, F.col(behaviour))}
    fields = [half_even(w * 100.0, 1).alias(f"{n}_weight_pct") for n, (w, _) in parts.items()]
    fields += [half_even(w * v, 2).alias(f"{n}_contribution") for n, (w, v) in parts.items()]
    total = parts["ml"][0] * parts["ml"][1] + parts["anomaly"][0] * parts["anomaly"][1] + parts["behavioral"][0] * parts["behavioral"][1]
    return df.withColumn("score_breakdown", F.struct(*fields, to_score(total).alias("hybrid_score")))


def calibrate_anomaly(raw: Column, low: Column, high: Column) -> Column:
    """Raw forest score to 0-100: the lower the raw score, the more anomalous."""
    share = (high - raw) / (high - low + F.lit(1e-6))
    return half_even(clip(share, 0.0, 1.0) * 100.0, 2)


def anomaly_flag(score: Column, cutoff: float = ANOMALY_CUTOFF) -> Column:
    return (score >= cutoff).cast("int")


def class_at(p: Column, threshold: float) -> Column:
    return (p >= threshold).cast("int")


# ---- reasons (fixed values: their wording and bounds) --------------------------------

def short_reason(signals: Column, score: Column) -> Column:
    """One line naming the fired signals, or why there are none."""
    named = F.concat(
        F.lit("Flagged by "), F.size(signals).cast("string"), F.lit(" risk signal(s): "),
        F.concat_ws("; ", F.transform(signals, lambda s: s["signal"])),
    )
    return (
        F.when(F.size(signals) > 0, named)
        .when(score >= 50, F.lit("Elevated statistical anomaly detected by unsupervised models."))
        .otherwise(F.lit("Transaction behavior aligns with routine customer spending patterns."))
    )


def reason_list(p: Column, anomaly: Column, signals: Column, score: Column) -> Column:
    """The reasons that apply: probability from 0.70, anomaly from 65, the first two signals."""
    first_two = F.concat_ws(", ", F.slice(F.transform(signals, lambda s: s["signal"]), 1, 2))
    found = F.array_compact(F.array(
        F.when(p >= 0.70, F.concat(F.lit("High fraud probability ("), fixed(p * 100.0, 1), F.lit("%) from supervised ML model."))),
        F.when(anomaly >= 65.0, F.concat(
            F.lit("Transaction behavior is statistically unusual (Anomaly Score: "), fixed(anomaly, 0), F.lit("/100)."))),
        F.when(F.size(signals) > 0, F.concat(F.lit("Triggered behavioral risk rules ("), first_two, F.lit(")."))),
    ))
    quiet = F.when(
        score <= 35, F.lit("Transaction conforms to typical historical patterns across all dimensions.")
    ).otherwise(F.lit("Elevated cumulative variance across multiple moderate risk signals."))
    return F.when(F.size(found) > 0, found).otherwise(F.array(quiet))
