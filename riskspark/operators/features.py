"""Fitted spend baselines and the eleven model features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.config import FEATURES
from riskspark.functions.calendar import age_years, is_night, monday_weekday
from riskspark.functions.geo import haversine_km
from riskspark.functions.numeric import nan_to_null
from riskspark.operators import lookups
from riskspark.operators.quantiles import quantiles
from riskspark.operators.velocity import WINDOWS, card_velocity
from riskspark.session import stored

EPSILON = 1e-5
UNLABELLED_RATE = 0.015  # fixed value: the fraud rate taken where no row is labelled


def global_baselines(df: DataFrame) -> DataFrame:
    """One row: mean and median amount, fraud rate."""
    rate = F.avg("is_fraud") if "is_fraud" in df.columns else F.lit(UNLABELLED_RATE)
    median = quantiles(df, "amt", {"median": 0.5}).scalar()
    return df.agg(F.avg(nan_to_null(F.col("amt"))).alias("global_mean"), rate.alias("global_rate")).withColumn("global_median", median)


def card_means(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("cc_num").isNotNull())
        .groupBy("cc_num")
        .agg(F.avg(nan_to_null(F.col("amt"))).alias("card_mean"), F.count(F.lit(1)).alias("card_rows"))
    )


def category_medians(df: DataFrame) -> DataFrame:
    return quantiles(df.where(F.col("category").isNotNull()), "amt", {"category_median": 0.5}, by=("category",))


def category_rates(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.avg("is_fraud").alias("category_rate"), F.count(F.lit(1)).alias("category_rows"))
    )


def amount_stats(df: DataFrame) -> DataFrame:
    """Mean and median amount, fraud rate and rows of every category, and of everything. Equal amounts of a category
    are counted first; both levels then share one quantile job."""
    fraud = F.col("is_fraud") if "is_fraud" in df.columns else F.lit(None).cast("int")
    counted = stored(
        df.groupBy("category", nan_to_null(F.col("amt").cast("double")).alias("amt"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(fraud).alias("frauds"), F.count(fraud).alias("labelled")), "amount-counts")
    scopes = F.array(F.struct(F.lit(True).alias("everything"), F.lit("").alias("scope")), F.struct(F.lit(False).alias("everything"), F.col("category").alias("scope")))
    scoped = counted.select("amt", "n", "frauds", "labelled", F.inline(scopes)).where(F.col("scope").isNotNull())
    by = ("everything", "scope")
    paid = F.when(F.col("amt").isNotNull(), F.col("n"))
    sums = scoped.groupBy(*by).agg(
        (F.sum(F.col("amt") * F.col("n")) / F.sum(paid)).alias("mean"), (F.sum("frauds") / F.sum("labelled")).alias("rate"), F.sum("n").alias("rows"))
    medians = quantiles(scoped, "amt", {"median": 0.5}, by=by, weight="n")
    unknown = F.lit(None).cast("double") if "is_fraud" in df.columns else F.when(F.col("everything"), F.lit(UNLABELLED_RATE))
    return sums.join(medians, list(by), "left").select(
        "everything", F.col("scope").alias("category"), "mean", F.coalesce("rate", unknown).alias("rate"), "rows", "median")


@dataclass
class Baselines:
    """Lookup tables fitted on one frame (the training split), applied to any other."""

    cards: DataFrame
    categories: DataFrame
    globals_: DataFrame
    small_cards: bool
    small_categories: bool
    hot_rows: int | None = None

    @classmethod
    def fit(cls, df: DataFrame, broadcast_rows: int | None = None, hot_rows: int | None = None) -> "Baselines":
        """Two tables are written: one row per card, and one row per category and one for all. The latter
        comes from one pass over the counts of equal amounts. Counted rows decide how lookups are joined."""
        cards, stats = stored(card_means(df), "cards"), stored(amount_stats(df), "amounts")
        categories = stats.where(~F.col("everything")).select(
            "category", F.col("rate").alias("category_rate"), F.col("rows").alias("category_rows"), F.col("median").alias("category_median"))
        whole = stats.where("everything").select(F.col("mean").alias("global_mean"), F.col("rate").alias("global_rate"), F.col("median").alias("global_median"))
        return cls(
            cards, categories, whole, lookups.fits(cards, broadcast_rows), lookups.fits(categories, broadcast_rows), hot_rows,
        )

    def save(self, path: str) -> None:
        self.cards.write.mode("overwrite").parquet(f"{path}/cards")
        self.categories.write.mode("overwrite").parquet(f"{path}/categories")
        self.globals_.write.mode("overwrite").parquet(f"{path}/globals")

    @classmethod
    def load(cls, spark: SparkSession, path: str, broadcast_rows: int | None = None) -> "Baselines":
        cards, categories = spark.read.parquet(f"{path}/cards"), spark.read.parquet(f"{path}/categories")
        return cls(
            cards, categories, spark.read.parquet(f"{path}/globals"),
            lookups.fits(cards, broadcast_rows), lookups.fits(categories, broadcast_rows),
        )

    def fallback(self, name: str) -> Column:
        """A global baseline as a scalar; all of them come from one subquery."""
        return self.globals_.select(F.struct("global_mean", "global_median", "global_rate")).scalar()[name]

    # -- joins ---------------------------------------------------------------

    def with_cards(self, df: DataFrame) -> DataFrame:
        """Adds ``card_mean``; an unseen card gets the global mean."""
        if "cc_num" not in df.columns:
            return df.withColumn("card_mean", self.fallback("global_mean"))
        key = "trans_num" if "trans_num" in df.columns else "trans_ts"
        joined = lookups.lookup_join(df, self.cards, "cc_num", self.small_cards, "card_rows", key, self.hot_rows)
        return joined.withColumn("card_mean", F.coalesce("card_mean", self.fallback("global_mean")))

    def with_categories(self, df: DataFrame) -> DataFrame:
        """Adds ``category_median`` and ``category_rate``; an unseen category gets the global values."""
        key = "trans_num" if "trans_num" in df.columns else "trans_ts"
        joined = lookups.lookup_join(
            df, self.categories, "category", self.small_categories, "category_rows", key, self.hot_rows
        )
        return joined.withColumns(
            {
                "category_median": F.coalesce("category_median", self.fallback("global_median")),
                "category_rate": F.coalesce("category_rate", self.fallback("global_rate")),
            }
        )


def spend_ratio(amt: Column, base: Column) -> Column:
    return amt / (base + F.lit(EPSILON))


def row_features(df: DataFrame) -> DataFrame:
    """The features that need only the row: calendar, age, distance."""
    ts = F.col("trans_ts")
    age = age_years(ts, F.col("dob")) if "dob" in df.columns else F.lit(40.0)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": monday_weekday(ts),
            "is_night_transaction": is_night(F.hour(ts)),
            "customer_age": age,
            "haversine_distance_km": haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")),
        }
    )


def add_features(
    df: DataFrame,
    base: Baselines,
    scope: tuple[str, ...] = (),
    velocity: bool = True,
    **velocity_options,
) -> DataFrame:
    """All features on the row. Ratio and rate columns the caller supplies pass through;
    velocity passes through only when both columns are there."""
    supplied = set(df.columns)
    out = df
    if velocity and not set(WINDOWS) <= supplied:  # first, while rows are narrow and nothing has been joined
        out = out.drop(*WINDOWS)
        if "cc_num" not in supplied:
            out = out.withColumn("cc_num", F.lit("UNKNOWN_CARD"))
        out = card_velocity(out, scope=scope, **velocity_options)
    out = row_features(out)
    if "amt_to_user_avg_ratio" not in supplied:
        out = base.with_cards(out).withColumn("amt_to_user_avg_ratio", spend_ratio(F.col("amt"), F.col("card_mean")))
    ratio_needed = "amt_to_cat_median_ratio" not in supplied
    rate_needed = "category_fraud_rate" not in supplied
    if ratio_needed or rate_needed:
        out = base.with_categories(out)
        if ratio_needed:
            out = out.withColumn("amt_to_cat_median_ratio", spend_ratio(F.col("amt"), F.col("category_median")))
        if rate_needed:
            out = out.withColumn("category_fraud_rate", F.col("category_rate"))
    return out.drop("card_mean", "category_median", "category_rate")


def feature_matrix(df: DataFrame, key: str = "trans_num") -> DataFrame:
    keep = [key] if key in df.columns else []
    return df.select(*keep, *FEATURES)
