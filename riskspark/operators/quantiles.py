"""Exact interpolated quantiles without gathering a group in one task.

Values are first counted per distinct value (partial aggregation absorbs
copies). A fixed monotone log scale cuts them into slices, the same for any
data; the slice counts (at most some 2.9 million per group, for all doubles) tell
which slices hold the wanted order statistics, and only those slices are ranked.
Null and NaN are missing; infinite values have slices of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PER_LOG = 2000  # slices per unit of the log scale: values of a slice are within 0.05 %


def _slice(v: Column) -> Column:
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * PER_LOG).cast("bigint")


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """One row per group with a column per named probability (linear interpolation). With ``weight`` a row
    stands for so many equal ones. A generator keeps the value a column, where the optimizer would otherwise
    compute it again in the filter, the grouping and the slice."""
    by = list(by)
    sliced = (
        df.select(*by, (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w"), F.explode(F.array(F.col(value).cast("double"))).alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*by, "_v")
        .agg(F.sum("_w").alias("_n"))
        .withColumn("_slice", _slice(F.col("_v")))
    )

    upto = W.partitionBy(*by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    histogram = sliced.groupBy(*by, "_slice").agg(F.sum("_n").alias("_rows"))
    wanted = [_targets(name, p) for name, p in probs.items()]
    targets = (
        histogram.withColumns(
            {
                "_before": F.coalesce(F.sum("_rows").over(upto), F.lit(0)),
                "_total": F.sum("_rows").over(whole),
            }
        )
        .withColumn("_targets", F.filter(F.concat(*wanted), lambda t: (t["k"] >= F.col("_before")) & (t["k"] < F.col("_before") + F.col("_rows"))))
        .where(F.size("_targets") > 0)
        .select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col("_slice").alias("_of_slice"), "_before", "_targets")
    )
    on = F.col("_slice") == F.col("_of_slice")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    # Without groups there are at most two target slices per probability.
    picked = sliced.join(targets if by else F.broadcast(targets), on)
    running = W.partitionBy(*by, "_slice").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    hits = (
        picked.withColumn("_upto", F.col("_before") + F.sum("_n").over(running))
        .withColumn("_hit", F.explode(F.filter("_targets", lambda t: (t["k"] < F.col("_upto")) & (t["k"] >= F.col("_upto") - F.col("_n")))))
    )
    columns = []
    for name in probs:
        low = F.max(F.when((F.col("_hit.name") == name) & (F.col("_hit.side") == 0), F.col("_v")))
        high = F.max(F.when((F.col("_hit.name") == name) & (F.col("_hit.side") == 1), F.col("_v")))
        share = F.max(F.when(F.col("_hit.name") == name, F.col("_hit.share")))
        columns.append(F.when(share == 0, low).otherwise(low + (high - low) * share).alias(name))
    return hits.groupBy(*by).agg(*columns)


def _targets(name: str, p: float) -> Column:
    """The two order statistics (0-based ranks) a probability interpolates between."""
    at = F.lit(float(p)) * (F.col("_total") - 1)
    low = F.floor(at)
    fields = lambda rank, side: F.struct(
        F.lit(name).alias("name"), rank.cast("bigint").alias("k"), F.lit(side).alias("side"), (at - low).alias("share")
    )
    return F.array(fields(low, 0), fields(F.least(low + 1, F.col("_total") - 1), 1))


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the median of each column; the columns share one pass."""
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_x")) for c in columns]))
    )
    per_column = quantiles(long, "_x", {"_m": 0.5}, by=("_c",))
    return per_column.agg(*[F.max(F.when(F.col("_c") == c, F.col("_m"))).alias(c) for c in columns])
