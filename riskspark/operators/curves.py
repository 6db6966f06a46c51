"""Precision-recall and ROC curves and their areas, exact over all distinct scores of full resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.functions.numeric import half_even, nan_to_null, ratio

PER_UNIT = 100  # slices per unit of log-odds, or of the log scale outside 0-1
LOG_ODDS = 40.0  # of the scores between 0 and 1
ROWS_PER_TASK = 500_000  # of a sliced histogram; a task keeps them in memory


def score_histogram(df: DataFrame, score: Column, label: str = "is_fraud", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; null and NaN scores are left out."""
    pos = (F.col(label) == 1).cast("bigint")
    return counted_histogram(df, score, pos, 1 - pos, by)


def counted_histogram(df: DataFrame, score: Column, pos: Column, neg: Column, by: Sequence[str] = ()) -> DataFrame:
    """The same from rows that stand for ``pos`` positives and ``neg`` negatives."""
    scored = df.withColumn("_score", nan_to_null(score.cast("double"))).where(F.col("_score").isNotNull())
    return scored.groupBy(*by, F.col("_score").alias("score")).agg(F.sum(pos).alias("pos"), F.sum(neg).alias("neg"))


def sliced_counts(df: DataFrame, score: Column, pos: Column, neg: Column, by: Sequence[str], rows: int) -> DataFrame:
    """``cumulative_counts`` of ``rows`` rows whose scores are nearly all distinct: they move once, to the task of their
    slice, where counting, running totals and areas all take place. Tasks grow in number with the rows, so that none
    spills; slice totals are summed before anything moves."""
    scored = df.select(*by, nan_to_null(score.cast("double")).alias("score"), pos.alias("pos"), neg.alias("neg")).where(F.col("score").isNotNull())
    sliced = scored.withColumn("_slice", _slice(F.col("score")))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    placed = sliced.repartition(tasks, *by, "_slice")
    histogram = placed.groupBy(*by, "_slice", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return cumulative_counts(histogram, by, sliced)


def _slice(score: Column) -> Column:
    """Slice of a score, monotone over all doubles: on the log-odds scale between 0 and 1, where model
    scores spread out instead of crowding at the ends, and on a log scale outside."""
    odds = F.log(F.greatest(score, F.lit(1e-17))) - F.log1p(-F.least(score, F.lit(1.0 - 1e-15)))
    inside = F.greatest(F.least(odds, F.lit(LOG_ODDS)), F.lit(-LOG_ODDS))
    place = F.when(score <= 0, -(LOG_ODDS + 1) - F.log1p(-score)).when(score >= 1, LOG_ODDS + 1 + F.log1p(score - 1)).otherwise(inside)
    return F.floor(place * PER_UNIT).cast("bigint")


def cumulative_counts(histogram: DataFrame, by: Sequence[str] = (), uncounted: DataFrame | None = None) -> DataFrame:
    """Adds tp and fp (rows scoring at least this much) and the class totals.

    A running total in two levels: slices of the score range are summed and
    accumulated first (at most some 8,000 rows per group for scores between 0
    and 1), then each slice runs on its own from what lies above it. Slices are summed from
    ``uncounted``, the sliced rows that the histogram counts, where these cost less.
    """
    by = list(by)
    sliced = histogram if "_slice" in histogram.columns else histogram.withColumn("_slice", _slice(F.col("score")))
    above = W.partitionBy(*by).orderBy(F.col("_slice").desc()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    offsets = (
        (sliced if uncounted is None else uncounted).groupBy(*by, "_slice")
        .agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
        .select(
            *[F.col(c).alias(f"_of_{c}") for c in by], F.col("_slice").alias("_of_slice"),
            F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_pos_above"),
            F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("_neg_above"),
            F.sum("_pos").over(whole).alias("positives"),
            F.sum("_neg").over(whole).alias("negatives"),
        )
    )
    inside = W.partitionBy(*by, "_slice").orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    on = F.col("_slice") == F.col("_of_slice")
    for c in by:  # plain equality, where it is enough, keeps the rows in the tasks of their slices
        on = on & (F.col(c).eqNullSafe(F.col(f"_of_{c}")) if sliced.schema[c].nullable else F.col(c) == F.col(f"_of_{c}"))
    return (
        sliced.join(offsets, on)
        .withColumns(
            {
                "tp": F.col("_pos_above") + F.sum("pos").over(inside),
                "fp": F.col("_neg_above") + F.sum("neg").over(inside),
            }
        )
        .select(*by, "score", "pos", "neg", "tp", "fp", "positives", "negatives")
    )


def areas(cumulative: DataFrame, by: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """PR-AUC (trapezoids, anchored at recall 0 and precision 1) and ROC-AUC per group.
    A point's predecessor is its own counts taken back, so no ordered window is needed."""
    tp, fp = F.col("tp"), F.col("fp")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    precision = ratio(tp, tp + fp)
    precision0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(ratio(tp0, tp0 + fp0))
    recall, recall0 = ratio(tp, F.col("positives")), ratio(tp0, F.col("positives"))
    fpr, fpr0 = ratio(fp, F.col("negatives")), ratio(fp0, F.col("negatives"))
    area_pr = F.sum((recall - recall0) * (precision + precision0) / 2.0)
    area_roc = F.sum((fpr - fpr0) * (recall + recall0) / 2.0)
    show = (lambda c: c) if digits is None else (lambda c: half_even(c, digits))
    return cumulative.groupBy(*by).agg(show(area_pr).alias("pr_auc"), show(area_roc).alias("roc_auc"))


def counts_by_score(df: DataFrame, score: Column, label: str = "is_fraud", by: Sequence[str] = ()) -> DataFrame:
    return cumulative_counts(score_histogram(df, score, label, by), by)


def curve_areas(df: DataFrame, score: Column, label: str = "is_fraud", by: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """Areas per group, rounded to ``digits`` for show."""
    return areas(counts_by_score(df, score, label, by), by, digits)


def curve_points(df: DataFrame, score: Column, label: str = "is_fraud", by: Sequence[str] = ()) -> DataFrame:
    """Threshold, precision, recall (= tpr) and fpr at every distinct score."""
    tp, fp = F.col("tp"), F.col("fp")
    return counts_by_score(df, score, label, by).select(
        *by, F.col("score").alias("threshold"), "tp", "fp",
        half_even(ratio(tp, tp + fp), 6).alias("precision"),
        half_even(ratio(tp, F.col("positives")), 6).alias("recall"),
        half_even(ratio(fp, F.col("negatives")), 6).alias("fpr"),
    )
