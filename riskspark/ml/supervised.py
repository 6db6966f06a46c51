"""Supervised models on Spark ML: weights, fits, selection, search, importance."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.config import FEATURES, SPLIT_SEED
from riskspark.functions.numeric import half_even
from riskspark.ml import boosting
from riskspark.operators.curves import curve_areas
from riskspark.operators.metrics import metrics_at
from riskspark.operators.split import hash_order
from riskspark.session import stored

WEIGHT = "_weight"
PARALLEL_FITS = 3
POSITIVE_WEIGHT = 61.61  # fixed value: legitimate rows per fraud

# The boosted-tree settings tried by the search.
SEARCH_GRID = (
    {"n_estimators": 80, "max_depth": 4, "learning_rate": 0.05, "scale_pos_weight": 30.0},
    {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.08, "scale_pos_weight": 61.61},
    {"n_estimators": 120, "max_depth": 6, "learning_rate": 0.08, "scale_pos_weight": 61.61},
    {"n_estimators": 150, "max_depth": 6, "learning_rate": 0.05, "scale_pos_weight": 61.61},
    {"n_estimators": 120, "max_depth": 7, "learning_rate": 0.03, "scale_pos_weight": 61.61},
    {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.12, "scale_pos_weight": 40.0},
)


def balanced_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Adds the weight that gives both classes the same total: rows / (2 * rows of the class)."""
    sizes = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"))).scalar()
    own = F.when(F.col(label) == 1, F.col("_sizes.pos")).otherwise(F.col("_sizes.n") - F.col("_sizes.pos"))
    return df.withColumn("_sizes", sizes).withColumn(WEIGHT, F.col("_sizes.n") / (2.0 * own)).drop("_sizes")


def positive_weights(df: DataFrame, weight: float = POSITIVE_WEIGHT, label: str = "is_fraud") -> DataFrame:
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))


@dataclass
class FraudModel:
    """A fitted pipeline from feature columns to a probability."""

    name: str
    pipeline: PipelineModel
    features: tuple[str, ...]

    def with_probability(self, df: DataFrame, name: str = "p_ml") -> DataFrame:
        helpers = [c for stage in self.pipeline.stages for c in _outputs(stage)]
        scored = self.pipeline.transform(df)
        return scored.withColumn(name, vector_to_array("probability")[1]).drop(*helpers)

    @property
    def classifier(self):
        return self.pipeline.stages[-1]

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, name: str, path: str) -> "FraudModel":
        pipeline = PipelineModel.load(path)
        return cls(name, pipeline, tuple(pipeline.stages[0].getInputCols()))


def _outputs(stage) -> list[str]:
    names = ("outputCol", "rawPredictionCol", "probabilityCol", "predictionCol")
    return [stage.getOrDefault(n) for n in names if stage.hasParam(n)]


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="error")


def _fit(name: str, df: DataFrame, stages: list, features: Sequence[str]) -> FraudModel:
    return FraudModel(name, Pipeline(stages=[_assembler(features), *stages]).fit(df), tuple(features))


def _fit_boosting(name: str, df: DataFrame, boosted: GBTClassifier, features: Sequence[str]) -> FraudModel:
    return FraudModel(name, PipelineModel([_assembler(features), boosting.fit(boosted, df, features)]), tuple(features))


def fit_logistic(df: DataFrame, features: Sequence[str] = FEATURES, label: str = "is_fraud", max_iter: int = 1000) -> FraudModel:
    """Standardized, class-balanced, L2 with strength 1 / total weight (balanced weights sum to the rows)."""
    weighted = balanced_weights(df, label)
    scaler = StandardScaler(inputCol="_x", outputCol="_scaled", withMean=True, withStd=True)
    logistic = LogisticRegression(
        featuresCol="_scaled", labelCol=label, weightCol=WEIGHT, regParam=1.0 / df.count(), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter,
    )
    return _fit("LogisticRegression", weighted, [scaler, logistic], features)


def fit_forest(
    df: DataFrame, trees: int = 100, depth: int = 10, features: Sequence[str] = FEATURES, label: str = "is_fraud", seed: int = SPLIT_SEED
) -> FraudModel:
    forest = RandomForestClassifier(featuresCol="_x", labelCol=label, weightCol=WEIGHT, numTrees=trees, maxDepth=depth, seed=seed)
    return _fit("RandomForest", balanced_weights(df, label), [forest], features)


def fit_histogram_boosting(
    df: DataFrame, rounds: int = 150, depth: int = 10, rate: float = 0.1, features: Sequence[str] = FEATURES, label: str = "is_fraud",
    seed: int = SPLIT_SEED,
) -> FraudModel:
    """Class-balanced boosting; MLlib's trees split on feature histograms."""
    boosted = GBTClassifier(
        featuresCol="_x", labelCol=label, weightCol=WEIGHT, maxIter=rounds, maxDepth=depth, stepSize=rate, maxBins=255, seed=seed
    )
    return _fit_boosting("HistGradientBoosting", balanced_weights(df, label), boosted, features)


def fit_boosted(df: DataFrame, params: dict, features: Sequence[str] = FEATURES, label: str = "is_fraud", seed: int = SPLIT_SEED) -> FraudModel:
    """Boosting with row and column subsampling and a positive-class weight."""
    boosted = GBTClassifier(
        featuresCol="_x", labelCol=label, weightCol=WEIGHT, maxIter=params.get("n_estimators", 120),
        maxDepth=params.get("max_depth", 6), stepSize=params.get("learning_rate", 0.08),
        subsamplingRate=params.get("subsample", 0.85), featureSubsetStrategy=str(params.get("colsample", 0.85)), seed=seed,
    )
    return _fit_boosting("BoostedTrees", positive_weights(df, params.get("scale_pos_weight", POSITIVE_WEIGHT), label), boosted, features)


def _scores(model: FraudModel, df: DataFrame, *columns: str) -> DataFrame:
    """Columns and probability, written: a plan over the model would score a row again for each use of the probability."""
    return stored(model.with_probability(df).select(*columns, "p_ml"), "scores")


def validation_scores(models: Sequence[FraudModel], df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """PR-AUC and ROC-AUC per model on one held-out frame."""
    rows = []
    for place, model in enumerate(models):
        area = curve_areas(_scores(model, df, label), F.col("p_ml"), label, digits=6)
        rows.append(area.withColumns({"model": F.lit(model.name), "place": F.lit(place)}))
    return reduce(lambda a, b: a.unionByName(b), rows)


def select_model(models: Sequence[FraudModel], df: DataFrame) -> tuple[FraudModel, DataFrame]:
    """The model of greatest validation PR-AUC; the earlier one keeps a tie."""
    scores = validation_scores(models, df)
    best = scores.agg(F.max_by("place", F.struct(F.col("pr_auc"), -F.col("place"))).alias("place")).first()["place"]
    return models[best], scores


def search(
    train: DataFrame, held: DataFrame, grid: Sequence[dict] = SEARCH_GRID, fit: Callable[..., FraudModel] = fit_boosted
) -> tuple[FraudModel, DataFrame]:
    """Fit every setting on the (kept) training frame, compare on the held-out frame; first wins a tie."""
    kept = train.persist()

    def tried(params: dict) -> tuple[FraudModel, DataFrame]:
        model = fit(kept, params)
        return model, _scores(model, held, "is_fraud", "amt")

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:  # fits of one frame share it and fill each other's waits
        models, scores = zip(*pool.map(tried, grid))
    rows = []
    for trial, (params, scored) in enumerate(zip(grid, scores), 1):
        area = curve_areas(scored, F.col("p_ml"), digits=5).select(F.struct("*")).scalar()
        at = metrics_at(scored, "p_ml", 0.5).withColumn("_area", area)
        rows.append(
            at.select(
                F.lit(trial).alias("trial"), *[F.lit(v).alias(k) for k, v in params.items()],
                F.col("_area.pr_auc").alias("val_pr_auc"), F.col("_area.roc_auc").alias("val_roc_auc"),
                F.col("f1").alias("val_f1"), "total_cost",
            )
        )
    history = stored(reduce(lambda a, b: a.unionByName(b), rows), "trials")
    best = history.agg(F.max_by("trial", F.struct(F.col("val_pr_auc"), -F.col("trial"))).alias("t")).first()["t"]
    kept.unpersist()
    return models[best - 1], history


def gain_importance(model: FraudModel, df: DataFrame) -> DataFrame:
    """Impurity-gain importance per feature, ranked."""
    values = [(f, float(v)) for f, v in zip(model.features, model.classifier.featureImportances.toArray())]
    table = df.sparkSession.createDataFrame(values, "feature string, importance double")
    total = F.sum("importance").over(W.partitionBy())
    place = F.row_number().over(W.partitionBy().orderBy(F.col("importance").desc(), "feature"))
    return table.select(place.alias("place"), "feature", half_even(F.col("importance"), 6).alias("importance"),
                        half_even(F.col("importance") / total * 100.0, 2).alias("share_pct"))


def permutation_importance(model: FraudModel, df: DataFrame, repeats: int = 5, key: str = "trans_num", seed: int = SPLIT_SEED, label: str = "is_fraud") -> DataFrame:
    """Loss of PR-AUC when one feature is reassigned between rows, averaged over ``repeats``.

    A repeat pairs the n-th row by one hash order with the n-th row by another, by a distributed sort and
    zip of positions, so every value is used once. The donor brings all its features; a row becomes one
    variant per feature, and the areas of all variants of all repeats come from one pass.
    """
    placed = stored(_with_positions(df.select(key, label, *model.features), hash_order(key, seed), "_at"), "placed")
    whole = curve_areas(model.with_probability(placed), F.col("p_ml"), label, digits=None).select("pr_auc").scalar()
    variants = F.array(*[
        F.struct(F.lit(f).alias("feature"), *[(F.col(f"_new.{g}") if g == f else F.col(g)).alias(g) for g in model.features]) for f in model.features])
    rows = []
    for repeat in range(repeats):
        donor = _with_positions(placed.select(key, *model.features), hash_order(key, seed + 1 + repeat), "_at").select("_at", F.struct(*model.features).alias("_new"))
        rows.append(placed.join(donor, "_at").select(label, F.lit(repeat).alias("repeat"), F.inline(variants)))
    scored = model.with_probability(reduce(lambda a, b: a.unionByName(b), rows)).select("repeat", "feature", label, "p_ml")
    each = curve_areas(stored(scored, "variants"), F.col("p_ml"), label, by=("repeat", "feature"), digits=None)
    return each.groupBy("feature").agg(F.avg("pr_auc").alias("_left")).select("feature", half_even(whole - F.col("_left"), 6).alias("importance"))


def _with_positions(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Rows numbered 0, 1, ... in a total order: bucket counts give each bucket its offset,
    rows are then numbered inside their bucket."""
    keyed = df.withColumns({"_h": order, "_bucket": F.substring(order, 1, 4)})
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))  # at most 65,536 buckets
    before = W.partitionBy().orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_bucket").orderBy("_h")
    return (
        keyed.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_h", "_bucket", "_before")
    )
