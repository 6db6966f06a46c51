"""Dataset profile and exploratory tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.config import ANOMALY_BANDS, FEATURES, TIERS
from riskspark.functions.calendar import is_night
from riskspark.functions.numeric import half_even, nan_to_null, percent
from riskspark.operators.lookups import fits
from riskspark.operators.quantiles import quantiles
from riskspark.session import stored

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _kind(field: T.StructField) -> str:
    return "numerical" if isinstance(field.dataType, NUMERIC) else "categorical"


def unpivot_row(row: DataFrame, name: str, values: dict[str, str]) -> DataFrame:
    """A one-row frame of columns to (name, value) rows; ``values`` maps label to column."""
    pairs = F.array(*[F.struct(F.lit(k).alias(name), F.col(c).alias("value")) for k, c in values.items()])
    return row.select(F.inline(pairs))


def dataset_profile(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Column by column: type, numerical or categorical, and the shape of the table."""
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    described = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit("target" if f.name == label else _kind(f)).alias("feature_kind"),
        ) for f in df.schema.fields
    ])
    return rows.select("row_count", F.lit(len(df.columns)).alias("column_count"), F.inline(described))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their share per column."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in df.columns])
    return counts.select("_rows", F.inline(pairs)).select(
        "column_name", "missing_count",
        half_even(percent(F.col("missing_count"), F.col("_rows")), 3).alias("missing_percentage"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
    ).select("duplicate_rows", half_even(percent(F.col("duplicate_rows"), F.col("row_count")), 2).alias("duplicate_pct"))


def cardinality(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column. Exact counts go through one shuffle of distinct
    (column, value) pairs, so a value that fills a third of the table costs nothing extra."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        return unpivot_row(row, "column_name", {c: c for c in df.columns}).withColumnRenamed("value", "distinct_values")
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("_v")) for c in df.columns])
    seen = df.select(F.inline(pairs)).groupBy("column_name", "_v").agg(F.lit(1).alias("_one"))
    return seen.groupBy("column_name").agg(F.count("_v").alias("distinct_values"))


def class_distribution(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    legit, fraud = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    rows = F.count(F.lit(1))
    return df.agg(
        legit.alias("legitimate_count"), half_even(percent(legit, rows), 2).alias("legitimate_percent"),
        fraud.alias("fraud_count"), half_even(percent(fraud, rows), 2).alias("fraud_percent"),
        half_even(legit / F.greatest(fraud, F.lit(1)), 2).alias("imbalance_ratio"),
    )


def amount_summary(df: DataFrame, amount: str = "amt", digits: int = 2) -> DataFrame:
    """Minimum, quartiles, mean, p99 and maximum."""
    q = quantiles(df, amount, {"p25": 0.25, "median": 0.5, "p75": 0.75, "p99": 0.99})
    picked = q.select(F.struct("*")).scalar()
    row = df.agg(F.min(amount).alias("min"), F.avg(amount).alias("mean"), F.max(amount).alias("max"))
    return row.select(
        half_even(F.col("min"), digits).alias("min"),
        *[half_even(picked[c], digits).alias(c) for c in ("p25", "median")],
        half_even(F.col("mean"), digits).alias("mean"),
        *[half_even(picked[c], digits).alias(c) for c in ("p75", "p99")],
        half_even(F.col("max"), digits).alias("max"),
    )


CLASS_PROBS = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def class_amount_stats(df: DataFrame, label: str = "is_fraud", amount: str = "amt", digits: int = 2) -> DataFrame:
    """Ten statistics of the amount per class (sample standard deviation)."""
    moments = df.groupBy(label).agg(
        F.avg(amount).alias("mean"), F.stddev_samp(amount).alias("std"), F.min(amount).alias("min"), F.max(amount).alias("max")
    )
    q = quantiles(df, amount, CLASS_PROBS, by=(label,))
    stats = ("mean", "std", "min", *CLASS_PROBS, "max")
    return moments.join(q, label).select(label, *[half_even(F.col(s), digits).alias(s) for s in stats])


def class_amount_ratios(stats: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Fraud over legitimate for mean, median, p95 and p99."""
    pick = lambda s, v: F.max(F.when(F.col(label) == v, F.col(s)))
    names = ("mean", "median", "p95", "p99")
    return stats.agg(*[half_even(pick(s, 1) / F.greatest(pick(s, 0), F.lit(0.01)), 2).alias(f"{s}_ratio") for s in names])


def iqr_tail(df: DataFrame, label: str = "is_fraud", amount: str = "amt") -> DataFrame:
    """Share of each class above the legitimate Q3 + 1.5 IQR."""
    q = quantiles(df.where(F.col(label) == 0), amount, {"q1": 0.25, "q3": 0.75})
    bound = q.select(F.col("q3") + (F.col("q3") - F.col("q1")) * 1.5).scalar()
    above, rows = F.count_if(F.col(amount) > F.col("_bound")), F.count(F.lit(1))
    return (
        df.withColumn("_bound", bound)
        .groupBy(label)
        .agg(
            half_even(F.max("_bound"), 2).alias("upper_bound"), rows.alias("total_rows"), above.alias("outliers"),
            half_even(percent(above, rows), 2).alias("outlier_pct"),
        )
    )


def night_day(df: DataFrame, label: str = "is_fraud", ts: str = "trans_ts") -> DataFrame:
    """Night against day: volume, fraud, rate, relative risk."""
    night = is_night(F.hour(ts)) == 1
    fraud = F.col(label) == 1
    row = df.agg(
        F.count_if(night).alias("night_total"), F.count_if(night & fraud).alias("night_fraud"),
        F.count_if(~night).alias("day_total"), F.count_if(~night & fraud).alias("day_fraud"),
    )
    night_rate, day_rate = percent(F.col("night_fraud"), F.col("night_total")), percent(F.col("day_fraud"), F.col("day_total"))
    return row.select(
        "*", half_even(night_rate, 2).alias("night_rate_pct"), half_even(day_rate, 2).alias("day_rate_pct"),
        half_even(night_rate / F.greatest(day_rate, F.lit(0.01)), 4).alias("relative_risk"),
    )


def category_summary(df: DataFrame, label: str = "is_fraud", amount: str = "amt") -> DataFrame:
    """Volume, fraud rate, mean amount and a risk label per category, riskiest first."""
    rate = half_even(F.avg(label) * 100.0, 2)
    out = df.where(F.col("category").isNotNull()).groupBy("category").agg(
        F.count(label).alias("total_transactions"), F.sum(F.col(label).cast("bigint")).alias("fraud_transactions"),
        rate.alias("fraud_rate_pct"), half_even(F.avg(amount), 2).alias("mean_amount"),
    )
    level = F.when(F.col("fraud_rate_pct") > 2.0, "HIGH").when(F.col("fraud_rate_pct") > 1.0, "MEDIUM").otherwise("LOW")
    return out.withColumn("risk_label", level).orderBy(F.col("fraud_rate_pct").desc(), "category")


def hourly_profile(df: DataFrame, label: str = "is_fraud", ts: str = "trans_ts") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.col(label).cast("bigint")).alias("fraud"),
        half_even(F.avg(label) * 100.0, 4).alias("rate_pct"),
    )


def _pair_correlations(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """a, b (places in ``columns``), correlation over the rows where both are known. A row is unpivoted to its
    pairs, which are summed before the shuffle: the aggregate stays small whatever the number of columns."""
    values = F.array(*[nan_to_null(F.col(c).cast("double")) for c in columns]).alias("_v")
    listed = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    long = df.select(values).select("_v", F.inline(listed))
    x, y = F.get("_v", F.col("a")), F.get("_v", F.col("b"))
    return long.groupBy("a", "b").agg(half_even(F.corr(x, y), 4).alias("correlation"))


def _named(columns: Sequence[str], place: str) -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col(place))


def label_correlations(df: DataFrame, features: Sequence[str] = FEATURES, label: str = "is_fraud") -> DataFrame:
    """Pearson correlation of each feature with the label, strongest first."""
    found = _pair_correlations(df, (*features, label), [(i, len(features)) for i in range(len(features))])
    return found.select(_named(features, "a").alias("feature"), "correlation").orderBy(F.abs("correlation").desc(), "feature")


def correlation_matrix(df: DataFrame, columns: Sequence[str] = (*FEATURES, "is_fraud")) -> DataFrame:
    """All pairs in long form, each correlated once."""
    found = _pair_correlations(df, columns, [(i, j) for i in range(len(columns)) for j in range(i, len(columns))])
    mirrored = F.array_distinct(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    return found.select("correlation", F.inline(mirrored)).select(_named(columns, "x").alias("feature_a"), _named(columns, "y").alias("feature_b"), "correlation")


def log_histogram(df: DataFrame, bins: int = 40, label: str = "is_fraud", amount: str = "amt") -> DataFrame:
    """Density per class over logarithmic bins between max(1, least) and the greatest amount.
    ``bins`` edges make ``bins`` - 1 bins; amounts below the first edge are not binned."""
    edges = df.agg(
        F.log10(F.greatest(F.min(amount), F.lit(1.0))).alias("lo"), F.log10(F.max(amount)).alias("hi")
    ).select(F.struct("lo", ((F.col("hi") - F.col("lo")) / (bins - 1)).alias("step"))).scalar()
    placed = (
        df.select(label, F.log10(amount).alias("_x"), edges.alias("_e"))
        .where(F.col("_x") >= F.col("_e.lo"))
        .select(label, "_e", F.least(F.floor((F.col("_x") - F.col("_e.lo")) / F.col("_e.step")), F.lit(bins - 2)).cast("int").alias("bin"))
    )
    counted = placed.groupBy(label, "bin").agg(F.count(F.lit(1)).alias("n"), F.first("_e").alias("_e"))
    totals = counted.groupBy(label).agg(F.sum("n").alias("_total"))  # one row per class
    low = F.pow(F.lit(10.0), F.col("_e.lo") + F.col("bin") * F.col("_e.step"))
    high = F.pow(F.lit(10.0), F.col("_e.lo") + (F.col("bin") + 1) * F.col("_e.step"))
    return counted.join(totals, label).select(
        label, "bin", "n", half_even(low, 4).alias("low"), half_even(high, 4).alias("high"),
        half_even(F.col("n") / (F.col("_total") * (high - low)), 8).alias("density"),
    )


def linear_histogram(df: DataFrame, value: str, bins: int = 40, low: float = 0.0, high: float = 100.0, label: str = "is_fraud") -> DataFrame:
    """Counts per class over equal bins; the top edge belongs to the last bin."""
    at = F.floor((F.col(value) - F.lit(low)) / F.lit((high - low) / bins))
    return (
        df.where(F.col(value).between(low, high))
        .groupBy(label, F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box_plot(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, mean, whisker ends (most extreme values within 1.5 IQR) and outlier count per group."""
    by = list(by)
    q = stored(quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=tuple(by)), "quartiles")
    q = F.broadcast(q) if fits(q) else q
    counted = df.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col(value) >= F.col("q1") - iqr * 1.5) & (F.col(value) <= F.col("q3") + iqr * 1.5)
    out = counted.join(q, by).groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"), F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("outliers"),
        (F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias("mean"),
    )
    names = ("q1", "median", "q3", "whisker_low", "whisker_high", "mean")
    return out.select(*by, *[half_even(F.col(c), 4).alias(c) for c in names], "outliers")


def anomaly_profile(df: DataFrame, flag: str = "is_anomalous", label: str = "is_fraud") -> DataFrame:
    """Normal against anomalous rows."""
    base = df.groupBy(flag).agg(
        F.count(F.lit(1)).alias("rows"), half_even(F.avg("amt"), 2).alias("mean_amount"),
        half_even(F.avg("haversine_distance_km"), 2).alias("mean_distance_km"),
        half_even(F.avg("amt_to_user_avg_ratio"), 2).alias("mean_user_ratio"),
        half_even(F.avg(label) * 100.0, 2).alias("fraud_rate_pct"),
    )
    q = quantiles(df, "amt", {"median_amount": 0.5}, by=(flag,))
    return base.join(q, flag).withColumn("median_amount", half_even(F.col("median_amount"), 2))


def anomaly_multipliers(profile: DataFrame, flag: str = "is_anomalous") -> DataFrame:
    """Anomalous over normal, denominators guarded like the report does (1 for money, 0.01 otherwise)."""
    pick = lambda c, v: F.max(F.when(F.col(flag) == v, F.col(c)))
    guards = {"mean_amount": 1.0, "median_amount": 1.0, "mean_distance_km": 1.0, "mean_user_ratio": 0.01, "fraud_rate_pct": 0.01}
    return profile.agg(*[half_even(pick(c, 1) / F.greatest(pick(c, 0), F.lit(g)), 2).alias(f"{c}_x") for c, g in guards.items()])


def band_rates(df: DataFrame, score: str, label: str = "is_fraud") -> DataFrame:
    """Fraud rate per anomaly band; empty bands keep their row."""
    s = F.col(score)
    rows = []
    for i, (low, high) in enumerate(ANOMALY_BANDS):
        inside = ((s >= low) if i == 0 else (s > low)) & (s <= high)
        rows.append(F.struct(
            F.lit(f"{int(low)}-{int(high)}").alias("band"), F.count_if(inside).alias("total"),
            F.count_if(inside & (F.col(label) == 1)).alias("fraud"),
        ))
    return df.agg(F.array(*rows).alias("_bands")).select(F.inline("_bands")).withColumn(
        "rate_pct", half_even(percent(F.col("fraud"), F.col("total")), 4)
    )


def tier_allocation(df: DataFrame, level: str = "risk_level", label: str = "is_fraud") -> DataFrame:
    """Rows, frauds and fraud rate per tier; a tier without rows keeps its row."""
    rows = [
        F.struct(
            F.lit(t).alias("risk_level"), F.count_if(F.col(level) == t).alias("total"),
            F.count_if((F.col(level) == t) & (F.col(label) == 1)).alias("fraud_count"),
        ) for t in TIERS
    ]
    return df.agg(F.array(*rows).alias("_tiers")).select(F.inline("_tiers")).withColumn(
        "fraud_rate_pct", half_even(percent(F.col("fraud_count"), F.col("total")), 2)
    )


def source_levels(df: DataFrame, sources: dict[str, Column]) -> DataFrame:
    """Mean and maximum of each score source."""
    rows = F.array(*[
        F.struct(F.lit(n).alias("source"), half_even(F.avg(c), 2).alias("mean_score"), half_even(F.max(c), 2).alias("max_score"))
        for n, c in sources.items()
    ])
    return df.agg(rows.alias("_rows")).select(F.inline("_rows"))
