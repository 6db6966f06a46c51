"""Join-shaped operators and set operations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.registry import query
from riskspark.catalog.views import features, probabilities, split_txn, stored_split, txn
from riskspark.config import simplex_weights
from riskspark.functions.numeric import half_even
from riskspark.operators import audit
from riskspark.operators.curves import curve_areas
from riskspark.operators.features import Baselines
from riskspark.operators.fusion import source_counts, with_weight_sets
from riskspark.operators.metrics import metrics_at, model_comparison
from riskspark.sources.fixtures import order_txn

_TRAIN_BASE = S.SPLIT + ", train AS (SELECT * FROM parts WHERE split = 'train'), test AS (SELECT * FROM parts WHERE split = 'test')" + S.baselines("train")


def _fitted(spark, sf_dir):
    """Baselines of the training split and the held-out rows."""
    parts = stored_split(spark, sf_dir)
    return Baselines.fit(parts.where("split = 'train'")), parts.where("split = 'test'")


@query(
    "jn01_card_mean_lookup",
    f"WITH {_TRAIN_BASE} SELECT trans_num, {S.r('coalesce(card_mean, global_mean)', 8)} AS card_mean FROM test LEFT JOIN cards USING (cc_num) CROSS JOIN gbase",
)
def card_lookup(spark, sf_dir):
    base, test = _fitted(spark, sf_dir)
    return base.with_cards(test).select("trans_num", half_even(F.col("card_mean"), 8).alias("card_mean"))


@query(
    "jn01b_card_mean_hot_keys",
    f"WITH {_TRAIN_BASE} SELECT trans_num, {S.r('coalesce(card_mean, global_mean)', 8)} AS card_mean FROM test LEFT JOIN cards USING (cc_num) CROSS JOIN gbase",
)
def card_lookup_spread(spark, sf_dir):
    """The plan for lookups too large to broadcast: hot cards apart, the rest in a shuffle join."""
    parts = stored_split(spark, sf_dir)
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    base = replace(Baselines.fit(train), small_cards=False, hot_rows=20)
    return base.with_cards(test).select("trans_num", half_even(F.col("card_mean"), 8).alias("card_mean"))


@query(
    "jn02_category_median_lookup",
    f"WITH {_TRAIN_BASE} SELECT trans_num, {S.r('coalesce(category_median, global_median)', 4)} AS category_median FROM test LEFT JOIN cats USING (category) CROSS JOIN gbase",
)
def median_lookup(spark, sf_dir):
    base, test = _fitted(spark, sf_dir)
    return base.with_categories(test).select("trans_num", half_even(F.col("category_median"), 4).alias("category_median"))


@query(
    "jn03_category_rate_lookup",
    f"WITH {_TRAIN_BASE} SELECT trans_num, {S.r('coalesce(category_rate, global_rate)', 6)} AS category_fraud_rate FROM test LEFT JOIN cats USING (category) CROSS JOIN gbase",
)
def rate_lookup(spark, sf_dir):
    base, test = _fitted(spark, sf_dir)
    return base.with_categories(test).select("trans_num", half_even(F.col("category_rate"), 6).alias("category_fraud_rate"))


@query(
    "jn04_features_on_rows",
    f"WITH {S.TXN}{S.features()} SELECT trans_num, cc_num, category, amt, is_fraud, {S.r('haversine_distance_km', 6)} AS haversine_distance_km, "
    "trans_velocity_24h, customer_age FROM feat",
)
def merged(spark, sf_dir):
    return features(spark, sf_dir).select(
        "trans_num", "cc_num", "category", "amt", "is_fraud",
        half_even(F.col("haversine_distance_km"), 6).alias("haversine_distance_km"), "trans_velocity_24h", "customer_age",
    )


_OVERLAPPING = S.SPLIT + ", seen AS (SELECT trans_num, split FROM parts UNION ALL SELECT trans_num, 'test' FROM parts WHERE split = 'train' AND trans_num::BIGINT % 50 = 0)"


def _with_overlap(spark, sf_dir):
    """The split table with some training rows repeated in test, so there is something to find."""
    parts = split_txn(spark, sf_dir).select("trans_num", "split")
    leaked = parts.where("split = 'train' and cast(trans_num as bigint) % 50 = 0").withColumn("split", F.lit("test"))
    return parts.unionByName(leaked)


@query(
    "jn05_cross_split_overlap",
    f"WITH {_OVERLAPPING} SELECT trans_num, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM seen GROUP BY trans_num HAVING count(DISTINCT split) > 1",
)
def overlap(spark, sf_dir):
    return audit.shared_ids(_with_overlap(spark, sf_dir)).select("trans_num", F.array_join("splits", ",").alias("splits"))


_COMPARED = "precision, recall, f1, fp, fn, total_cost"


@query(
    "jn06_model_comparison",
    f"WITH {S.PROBS}" + S.confusion("probs", "p_ml >= 0.4", "a") + S.confusion("probs", "s_anom >= 65", "b")
    + " ".join(
        f" {'UNION ALL ' if i else ''}SELECT '{n}' AS model, {_COMPARED} FROM (SELECT *, {S.RATES}, {S.costs()} FROM {t})"
        for i, (n, t) in enumerate((("supervised", "a"), ("anomaly", "b")))
    ),
)
def comparison(spark, sf_dir):
    df = probabilities(spark, sf_dir)
    rows = {"supervised": metrics_at(df, "p_ml", 0.4), "anomaly": metrics_at(df, "s_anom", 65.0)}
    return model_comparison({n: m.select(*_COMPARED.split(", ")) for n, m in rows.items()})


_GRID_VALUES = ", ".join(f"({i}, {a!r}::DOUBLE, {b!r}::DOUBLE, {c!r}::DOUBLE)" for i, a, b, c in simplex_weights())


@query(
    "jn07_grid_product",
    f"WITH {S.PROBS}, grid(config, w_ml, w_anomaly, w_rules) AS (VALUES {_GRID_VALUES}) SELECT config, count(*) AS rows, "
    f"{S.r('avg(w_ml * p_ml + w_anomaly * s_anom / 100)', 6)} AS mean_score FROM probs CROSS JOIN grid GROUP BY config",
)
def grid(spark, sf_dir):
    """The grid meets distinct score pairs with their counts, not the rows."""
    pairs = source_counts(probabilities(spark, sf_dir), ("p_ml", "s_anom")).withColumn("n", F.col("pos") + F.col("neg"))
    out = with_weight_sets(pairs, simplex_weights())
    score = F.col("w_ml") * F.col("p_ml") + F.col("w_anomaly") * F.col("s_anom") / 100.0
    return out.groupBy("config").agg(F.sum("n").alias("rows"), half_even(F.sum(score * F.col("n")) / F.sum("n"), 6).alias("mean_score"))


@query(
    "jn08_orders_baseline",
    f"""WITH {S.ORDERS}, c AS (SELECT cc_num, avg(amt) AS card_mean FROM otxn GROUP BY cc_num),
    k AS (SELECT category, quantile_cont(amt, 0.5) AS med FROM otxn GROUP BY category)
    SELECT trans_num, {S.r('amt / (card_mean + 1e-5)', 6)} AS user_ratio, {S.r('amt / (med + 1e-5)', 6)} AS category_ratio
    FROM otxn JOIN c USING (cc_num) JOIN k USING (category)""",
)
def orders_baseline(spark, sf_dir):
    """Both spend lookups on the second source."""
    df = order_txn(spark, sf_dir)
    base = Baselines.fit(df)
    out = base.with_categories(base.with_cards(df))
    ratio = lambda c: half_even(F.col("amt") / (F.col(c) + F.lit(1e-5)), 6)
    return out.select("trans_num", ratio("card_mean").alias("user_ratio"), ratio("category_median").alias("category_ratio"))


@query(
    "so01_split_intersection",
    f"WITH {_OVERLAPPING} SELECT trans_num FROM seen WHERE split = 'train' INTERSECT SELECT trans_num FROM seen WHERE split = 'test'",
)
def intersection(spark, sf_dir):
    seen = _with_overlap(spark, sf_dir)
    ids = lambda s: seen.where(F.col("split") == s).select("trans_num")
    return ids("train").intersect(ids("test"))


@query(
    "so02_label_subset",
    f"WITH {S.TXN}, l AS (SELECT DISTINCT is_fraud + CASE WHEN trans_num::BIGINT % 1000 = 7 THEN 2 ELSE 0 END AS label FROM txn) SELECT CAST(label AS INTEGER) AS label FROM l WHERE label NOT IN (0, 1)",
)
def label_subset(spark, sf_dir):
    """Labels outside {0, 1}; some rows are given such a label to be found."""
    odd = F.when(F.col("trans_num").cast("bigint") % 1000 == 7, 2).otherwise(0)
    labels = txn(spark, sf_dir).select((F.col("is_fraud") + odd).alias("label")).distinct()
    allowed = spark.range(2).select(F.col("id").cast("int").alias("label"))
    return labels.exceptAll(allowed)


@query(
    "so03_union_of_evaluations",
    f"WITH {S.SCORED}" + "".join(S.confusion("scored", f"hybrid_score >= {t}", f"c{t}") for t in (25, 50))
    + f" SELECT 25::DOUBLE AS threshold, {_COMPARED} FROM (SELECT *, {S.RATES}, {S.costs()} FROM c25) UNION ALL "
    f"SELECT 50::DOUBLE, {_COMPARED} FROM (SELECT *, {S.RATES}, {S.costs()} FROM c50)",
)
def union_rows(spark, sf_dir):
    from riskspark.catalog.views import scored

    df = scored(spark, sf_dir)
    keep = ["threshold", *_COMPARED.split(", ")]
    return metrics_at(df, "hybrid_score", 25).select(*keep).unionByName(metrics_at(df, "hybrid_score", 50).select(*keep))
