"""Preprocess, score, train, evaluate and explain whole tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.config import FROZEN_FUSION, TIERS, UNIT_FUSION, WITH_OPERATIONS, WITHOUT_OPERATIONS, FusionConfig, simplex_weights
from riskspark.functions.numeric import half_even
from riskspark.functions.text import anomaly_reason
from riskspark.ml import supervised
from riskspark.ml.attribution import explain
from riskspark.ml.iforest import IsolationForest
from riskspark.operators import fusion
from riskspark.operators.clean import clean, fill_coordinates, infer_night_flag
from riskspark.operators.cost import cheapest, counted_confusion, policy_columns, rates, sweep
from riskspark.operators.curves import areas, counted_histogram, cumulative_counts
from riskspark.operators.explain import top_factors
from riskspark.operators.features import Baselines, add_features
from riskspark.operators.metrics import best_of, metric_columns
from riskspark.operators.rules import apply_rules, apply_signals
from riskspark.operators.split import stratified_split
from riskspark.session import shared_folder, stored
from riskspark.sources import store


@dataclass
class Prepared:
    """The cleaned table with its split column, and baselines fitted on the training rows."""

    table: DataFrame
    baselines: Baselines

    def features(self) -> DataFrame:
        """Features of every split; velocity sees only rows of its own split."""
        return add_features(self.table, self.baselines, scope=("split",))


def preprocess(raw: DataFrame, order: tuple[str, ...] = (), path: str | None = None) -> Prepared:
    """The split table is written once (below the shared folder unless ``path`` says where), so fits and
    features read files, by split, instead of cleaning again."""
    spark = raw.sparkSession
    path = path or shared_folder(spark, "prepared")
    store.write_splits(stratified_split(clean(raw, order=order)), path)
    table = store.read_split(spark, path)
    return Prepared(table, Baselines.fit(table.where(F.col("split") == "train")))


def score_table(df: DataFrame, cfg: FusionConfig = FROZEN_FUSION, details: bool = True) -> DataFrame:
    """Rows with features, ``p_ml`` and ``s_anom`` to signals, fused score, tier, action and reason."""
    out = fusion.apply_fusion(apply_signals(df, details=details), cfg)
    if details:
        out = out.withColumn("explanation", fusion.short_reason(F.col("signals"), F.col("hybrid_score")))
    return out


def score_with_models(df: DataFrame, model: supervised.FraudModel, forest: IsolationForest, cfg: FusionConfig = FROZEN_FUSION) -> DataFrame:
    return score_table(forest.with_scores(model.with_probability(df)), cfg)


def explain_table(scored: DataFrame, cfg: FusionConfig = FROZEN_FUSION) -> DataFrame:
    """The nested result record per row: parts of the score, reasons, anomaly wording; with a
    ``contributions`` column also the top factors."""
    out = fusion.score_breakdown(scored, cfg)
    reason = anomaly_reason(*[F.col(c) for c in ("s_anom", "haversine_distance_km", "amt_to_user_avg_ratio", "amt", "is_night_transaction")])
    factors = ()
    if "contributions" in scored.columns:
        out, factors = top_factors(out), ("top_risk_factors", "protective_factors")
    return out.select(
        F.col("trans_num").alias("transaction_id"),
        half_even(F.col("p_ml"), 4).alias("fraud_probability"),
        half_even(F.col("s_anom"), 2).alias("anomaly_score"),
        half_even(F.col("behavioral_score"), 2).alias("behavioral_risk"),
        "hybrid_score", "risk_level", "recommended_action", *factors,
        reason.alias("anomaly_explanation"), F.col("signals").alias("behavioral_signals"), "score_breakdown",
        fusion.reason_list(F.col("p_ml"), F.col("s_anom"), F.col("signals"), F.col("hybrid_score")).alias("explanation_summary"),
    )


def explain_with_models(df: DataFrame, model: supervised.FraudModel, forest: IsolationForest, cfg: FusionConfig = FROZEN_FUSION) -> DataFrame:
    return explain_table(explain(model, score_with_models(df, model, forest, cfg)), cfg)


def held_out_evaluation(scored: DataFrame, cfg: FusionConfig = FROZEN_FUSION) -> DataFrame:
    """One row: metrics at the frozen cut-off, costs against approving everything, tier sizes. The rows are
    passed once: counts and amounts per label, whole score and tier, a few hundred at most, carry all of it."""
    cells = stored(
        scored.groupBy("is_fraud", "hybrid_score", "risk_level").agg(F.count(F.lit(1)).alias("n"), F.sum("amt").alias("amount")), "evaluation")
    pos = F.col("is_fraud") == 1
    none = F.lit(0).cast("bigint")
    histogram = counted_histogram(cells, F.col("hybrid_score") / 100.0, F.when(pos, F.col("n")).otherwise(none), F.when(pos, none).otherwise(F.col("n")))
    area = areas(cumulative_counts(histogram)).select(F.struct("*")).scalar()
    tiers = [F.coalesce(F.sum(F.when(F.col("risk_level") == t, F.col("n"))), none).alias(f"{t.split()[0].lower()}_risk_rows") for t in TIERS]
    r = rates()
    row = counted_confusion(cells, F.col("hybrid_score") >= cfg.cutoff)
    named = row.withColumns({"_area": area, "_tiers": cells.agg(*tiers).select(F.struct("*")).scalar()}).select("*", "_area.*", "_tiers.*")
    return named.select(
        *metric_columns("hybrid"), r["accuracy"].alias("accuracy"), r["specificity"].alias("specificity"), r["fnr"].alias("false_negative_rate"),
        *policy_columns(WITHOUT_OPERATIONS), *[f"{t.split()[0].lower()}_risk_rows" for t in TIERS])


@dataclass
class Trained:
    model: supervised.FraudModel
    forest: IsolationForest
    fusion: FusionConfig
    baselines: Baselines
    report: DataFrame
    sweep: DataFrame


def train(
    raw: DataFrame, order: tuple[str, ...] = (), candidates=None, trees: int = 120, calibrate_on: str = "val"
) -> Trained:
    """Clean, split, fit features, choose a classifier by validation PR-AUC, grow the forest, choose
    fusion weights and the cost-optimal cut-off on ``calibrate_on``, and report on the test split."""
    prepared = preprocess(raw, order)
    df = stored(prepared.features(), "features")
    part = lambda s: df.where(F.col("split") == s)
    candidates = candidates or (supervised.fit_forest, supervised.fit_histogram_boosting)
    model, _ = supervised.select_model([fit(part("train")) for fit in candidates], part("val"))
    forest = IsolationForest.fit(part("train"), trees=trees)

    sources = stored(forest.with_scores(model.with_probability(apply_rules(df))).select(
        "trans_num", "split", "is_fraud", "amt", "p_ml", (F.col("s_anom") / 100.0).alias("s_anom"), "rule_score"), "sources")
    held = sources.where(F.col("split") == "val")
    mixed = F.col("w_ml") * F.col("p_ml") + F.col("w_anomaly") * F.col("s_anom") + F.col("w_rules") * F.col("rule_score")
    grid = fusion.grid_areas(held, simplex_weights(), mixed, ("p_ml", "s_anom", "rule_score"), digits=9)
    _, ml, anomaly, rules = simplex_weights()[best_of(grid).first()["config"]]
    cfg = replace(UNIT_FUSION, w_ml=ml, w_anomaly=anomaly, w_rules=rules)

    scored = fusion.apply_fusion(sources, cfg, behaviour="rule_score")
    swept = sweep(scored.where(F.col("split") == calibrate_on), "hybrid_score", cfg=WITH_OPERATIONS)
    cfg = replace(cfg, cutoff=int(cheapest(swept).first()["threshold"]))
    test = scored.where(F.col("split") == "test")
    report = held_out_evaluation(test, cfg).withColumns(
        {
            "model_name": F.lit(f"Hybrid ({model.name} + anomaly + rules)"), "optimal_threshold": F.lit(cfg.cutoff),
            "w_ml": F.lit(ml), "w_anomaly": F.lit(anomaly), "w_rules": F.lit(rules),
        }
    )
    return Trained(model, forest, cfg, prepared.baselines, report, swept)


# The day and hour of a request that names no time.
REQUEST_DAY, DEFAULT_HOUR = (2026, 8, 27), 14


def request_table(df: DataFrame) -> DataFrame:
    """Request rows made scorable: the night flag inferred, coordinates filled, the time set to half
    past the stated hour of a fixed day. A stated distance only places the merchant; the distance
    feature is recomputed from the coordinates."""
    have = set(df.columns)
    out = infer_night_flag(df) if {"hour", "is_night_transaction"} <= have else df
    if "trans_ts" not in have:
        hour = F.coalesce(F.col("hour"), F.lit(DEFAULT_HOUR)) if "hour" in have else F.lit(DEFAULT_HOUR)
        day = [F.lit(part) for part in REQUEST_DAY]
        out = out.withColumn("trans_ts", F.make_timestamp(*day, hour, F.lit(30), F.lit(0)))
    return fill_coordinates(out)
