"""Per-row factors from feature contributions, and the choice of case studies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.config import FEATURES
from riskspark.functions.text import display_name, feature_sentence


def linear_contributions(
    df: DataFrame, weights: dict[str, float], means: dict[str, Column | float], base: float = 0.0, name: str = "contributions"
) -> DataFrame:
    """Exact attribution of a linear score: weight times distance from the mean, per feature.
    Adds the contributions as an array of (feature, value, contribution)."""
    items = []
    for f, w in weights.items():
        mean = means[f] if isinstance(means[f], Column) else F.lit(float(means[f]))
        x = F.col(f).cast("double")
        items.append(F.struct(F.lit(f).alias("feature"), x.alias("value"), (F.lit(float(w)) * (x - mean)).alias("contribution")))
    return df.withColumns({name: F.array(*items), "base_value": F.lit(float(base))})


def _described(c: Column) -> Column:
    return F.struct(
        c["feature"].alias("feature"), display_name(c["feature"]).alias("display_name"),
        c["value"].alias("feature_value"), c["contribution"].alias("contribution"),
        F.when(c["contribution"] > 0, "increases_risk").otherwise("decreases_risk").alias("impact"),
        feature_sentence(c["feature"], c["value"], c["contribution"]).alias("explanation"),
    )


def _largest(items: Column, key, k: int) -> Column:
    """First k by ascending key; feature name settles ties."""
    keyed = F.transform(items, lambda c: F.struct(key(c).alias("_key"), c["feature"].alias("_f"), c.alias("_item")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: s["_item"])


def top_factors(df: DataFrame, k: int = 5, contributions: str = "contributions") -> DataFrame:
    """Adds ``top_risk_factors`` (largest positive first) and ``protective_factors`` (most negative first)."""
    c = F.col(contributions)
    up = _largest(F.filter(c, lambda x: x["contribution"] > 0), lambda x: -x["contribution"], k)
    down = _largest(F.filter(c, lambda x: x["contribution"] < 0), lambda x: x["contribution"], k)
    return df.withColumns({"top_risk_factors": F.transform(up, _described), "protective_factors": F.transform(down, _described)})


def bar_factors(df: DataFrame, k: int = 8, contributions: str = "contributions") -> DataFrame:
    """Adds ``drivers``: the k largest contributions by size, whatever their sign."""
    return df.withColumn("drivers", _largest(F.col(contributions), lambda x: -F.abs(x["contribution"]), k))


def global_attribution(df: DataFrame, contributions: str = "contributions") -> DataFrame:
    """Mean absolute contribution per feature over all rows, strongest first."""
    long = df.select(F.explode(contributions).alias("c")).select("c.*")
    out = long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    return out.withColumn("display_name", display_name(F.col("feature"))).orderBy(F.col("mean_abs_contribution").desc(), "feature")


def dependence(df: DataFrame, feature: str = "amt_to_user_avg_ratio", key: str = "trans_num", contributions: str = "contributions") -> DataFrame:
    """Feature value against its contribution, row by row."""
    one = F.filter(contributions, lambda x: x["feature"] == feature)[0]
    return df.select(key, one["value"].alias("feature_value"), one["contribution"].alias("contribution"))


def case_studies(df: DataFrame, p: str = "p_ml", anomaly: str = "s_anom", order: str = "trans_num", keep: Sequence[str] = ("amt", "category")) -> DataFrame:
    """Five rows worth explaining, each found by a bounded top-k."""
    columns = [order, "is_fraud", *keep, p, anomaly]
    rows = df.select(*columns)
    fraud, legit = rows.where("is_fraud = 1"), rows.where("is_fraud = 0")

    def first(frame: DataFrame, *by, skip: int = 0) -> DataFrame:
        return frame.orderBy(*by, order).limit(skip + 1).offset(skip) if skip else frame.orderBy(*by, order).limit(1)

    in_band = F.when(F.col(anomaly).between(40.0, 65.0), 0).otherwise(1)
    flagged = F.when(F.col(anomaly) >= 65.0, 0).otherwise(1)
    spend = F.when(F.col(anomaly) >= 65.0, F.lit(0.0)).otherwise(-F.col("amt"))
    picks = {
        "1_confirmed_fraud": first(fraud),
        "2_routine_legitimate": first(legit, skip=10),
        "3_moderate_anomaly": first(rows, in_band),
        "4_false_positive": first(legit, flagged, spend),
        "5_borderline_fraud": first(fraud, F.col(p)),
    }
    return reduce(lambda a, b: a.unionByName(b), [f.withColumn("case", F.lit(n)) for n, f in picks.items()])


def feature_array(df: DataFrame, features: Sequence[str] = FEATURES) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])
