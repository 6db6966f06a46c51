"""Velocity windows, curves, ranks, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.aggregates import CORRELATIONS, _CATEGORY
from riskspark.catalog.registry import query
from riskspark.catalog.views import features, probabilities, scored, split_txn, txn, txn_dense
from riskspark.config import FEATURES, simplex_weights
from riskspark.functions.numeric import half_even
from riskspark.operators import explain, metrics
from riskspark.operators import profile as P
from riskspark.operators.cost import cheapest, sweep
from riskspark.operators.curves import curve_areas, curve_points
from riskspark.operators.fusion import with_weight_sets
from riskspark.operators.velocity import WINDOWS, card_velocity

NARROW = ("trans_num", "trans_ts", "cc_num", "amt")


def _velocity(df, name, **kw):
    return card_velocity(df.select(*NARROW, *kw.get("scope", ())), windows={name: WINDOWS[name]}, **kw).select("trans_num", name)


@query("wn01_velocity_1h", f"WITH {S.DENSE}{S.velocity('dense', 'v')} SELECT trans_num, trans_velocity_1h FROM v")
def velocity_1h(spark, sf_dir):
    return _velocity(txn_dense(spark, sf_dir), "trans_velocity_1h")


@query("wn02_velocity_24h", f"WITH {S.DENSE}{S.velocity('dense', 'v')} SELECT trans_num, trans_velocity_24h FROM v")
def velocity_24h(spark, sf_dir):
    return _velocity(txn_dense(spark, sf_dir), "trans_velocity_24h")


@query("wn01b_velocity_hot_cards", f"WITH {S.DENSE}{S.velocity('dense', 'v')} SELECT trans_num, trans_velocity_1h, trans_velocity_24h FROM v")
def velocity_hot(spark, sf_dir):
    """The plan for cards too heavy for one task: slices of a bounded number of moves with carried counts."""
    df = txn_dense(spark, sf_dir).select(*NARROW)
    n = df.count()
    out = card_velocity(df, hot_rows=n // 20, slice_rows=max(n // 100, 1))
    return out.select("trans_num", "trans_velocity_1h", "trans_velocity_24h")


@query("wn02b_velocity_per_split", f"WITH {S.SPLIT}{S.velocity('parts', 'v', scope='split')} SELECT trans_num, split, trans_velocity_1h, trans_velocity_24h FROM v")
def velocity_scoped(spark, sf_dir):
    df = split_txn(spark, sf_dir).select(*NARROW, "split")
    return card_velocity(df, scope=("split",)).select("trans_num", "split", "trans_velocity_1h", "trans_velocity_24h")


@query(
    "wn03_ranked_features",
    f"WITH {S.TXN}{S.features()}, c AS ({CORRELATIONS}) SELECT feature, abs(correlation) AS strength, CAST(row_number() OVER (ORDER BY abs(correlation) DESC, feature) AS INTEGER) AS place FROM c",
)
def ranked_features(spark, sf_dir):
    strengths = P.label_correlations(features(spark, sf_dir)).select("feature", F.abs("correlation").alias("strength"))
    return metrics.ranked(strengths, "strength", "feature")


@query(
    "wn04_curve_points",
    f"WITH {S.PROBS}{S.curve('probs', 'p_ml')} SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
    f"{S.r(S.div('tp', 'tp + fp'), 6)} AS precision, {S.r(S.div('tp', 'positives'), 6)} AS recall, {S.r(S.div('fp', 'negatives'), 6)} AS fpr FROM curve",
)
def points(spark, sf_dir):
    return curve_points(probabilities(spark, sf_dir), F.col("p_ml"))


@query("wn05_trapezoid_area", f"WITH {S.SPLIT_PROBS}{S.curve('probs', 'p_ml', 'split')}{S.area('curve', 'split')} SELECT * FROM area")
def trapezoid(spark, sf_dir):
    return curve_areas(probabilities(spark, sf_dir, split=True), F.col("p_ml"), by=("split",))


@query("wn05b_area_full_resolution", f"WITH {S.PROBS}{S.curve('probs', 'p_ml')}{S.area('curve')} SELECT * FROM area")
def trapezoid_full(spark, sf_dir):
    """The two-level running totals used for scores that are not rounded."""
    return curve_areas(probabilities(spark, sf_dir), F.col("p_ml"))


@query("tk01_chronological", f"WITH {S.TXN} SELECT cc_num, epoch_us(trans_ts) AS ts_us, trans_num, amt FROM txn ORDER BY cc_num, trans_ts, trans_num")
def chronological(spark, sf_dir):
    return txn(spark, sf_dir).orderBy("cc_num", "trans_ts", "trans_num").select("cc_num", F.unix_micros("trans_ts").alias("ts_us"), "trans_num", "amt")


@query("tk02_top_categories", f"WITH {S.TXN}, {_CATEGORY} SELECT category, fraud_rate_pct FROM cl ORDER BY fraud_rate_pct DESC, category LIMIT 5")
def top_categories(spark, sf_dir):
    return P.category_summary(txn(spark, sf_dir)).limit(5).select("category", "fraud_rate_pct")


# Linear surrogate weights for attribution queries; any fixed weights serve.
WEIGHTS = {f: round(0.1 * (i + 1) * (-1) ** i, 1) for i, f in enumerate(FEATURES)}
MEANS = {f: float(i) for i, f in enumerate(FEATURES)}


def contributed(spark, sf_dir):
    return explain.linear_contributions(features(spark, sf_dir), WEIGHTS, MEANS)


CONTRIBUTIONS = S.TXN + S.features() + ", con AS (" + " UNION ALL ".join(
    f"SELECT trans_num, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {WEIGHTS[f]!r}::DOUBLE * ({f} - {MEANS[f]!r}::DOUBLE) AS contribution FROM feat" for f in FEATURES
) + ")"


@query(
    "tk03_top_factors",
    f"""WITH {CONTRIBUTIONS}, up AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY contribution DESC, feature) AS rn FROM con WHERE contribution > 0) WHERE rn <= 5),
    dn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY contribution, feature) AS rn FROM con WHERE contribution < 0) WHERE rn <= 5),
    u AS (SELECT trans_num, string_agg(feature, ',' ORDER BY rn) AS risk_factors FROM up GROUP BY trans_num),
    d AS (SELECT trans_num, string_agg(feature, ',' ORDER BY rn) AS protective_factors FROM dn GROUP BY trans_num)
    SELECT trans_num, coalesce(risk_factors, '') AS risk_factors, coalesce(protective_factors, '') AS protective_factors
    FROM txn LEFT JOIN u USING (trans_num) LEFT JOIN d USING (trans_num)""",
)
def top_factors(spark, sf_dir):
    out = explain.top_factors(contributed(spark, sf_dir), 5)
    return out.select(
        "trans_num", F.array_join("top_risk_factors.feature", ",").alias("risk_factors"),
        F.array_join("protective_factors.feature", ",").alias("protective_factors"),
    )


@query(
    "tk04_bar_factors",
    f"""WITH {CONTRIBUTIONS}, t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY abs(contribution) DESC, feature) AS rn FROM con) WHERE rn <= 8)
    SELECT trans_num, string_agg(feature, ',' ORDER BY rn) AS drivers FROM t GROUP BY trans_num""",
)
def bar_factors(spark, sf_dir):
    return explain.bar_factors(contributed(spark, sf_dir), 8).select("trans_num", F.array_join("drivers.feature", ",").alias("drivers"))


_CASE = "trans_num, is_fraud, amt, category, p_ml, s_anom"


@query(
    "tk05_case_studies",
    f"""WITH {S.PROBS}
    (SELECT '1_confirmed_fraud' AS "case", {_CASE} FROM probs WHERE is_fraud = 1 ORDER BY trans_num LIMIT 1) UNION ALL
    (SELECT '2_routine_legitimate', {_CASE} FROM probs WHERE is_fraud = 0 ORDER BY trans_num LIMIT 1 OFFSET 10) UNION ALL
    (SELECT '3_moderate_anomaly', {_CASE} FROM probs ORDER BY CASE WHEN s_anom BETWEEN 40 AND 65 THEN 0 ELSE 1 END, trans_num LIMIT 1) UNION ALL
    (SELECT '4_false_positive', {_CASE} FROM probs WHERE is_fraud = 0 ORDER BY CASE WHEN s_anom >= 65 THEN 0 ELSE 1 END, CASE WHEN s_anom >= 65 THEN 0 ELSE -amt END, trans_num LIMIT 1) UNION ALL
    (SELECT '5_borderline_fraud', {_CASE} FROM probs WHERE is_fraud = 1 ORDER BY p_ml, trans_num LIMIT 1)""",
)
def case_studies(spark, sf_dir):
    return explain.case_studies(probabilities(spark, sf_dir))


@query("tk06_busiest_card", f"WITH {S.TXN} SELECT cc_num, count(*) AS n FROM txn GROUP BY cc_num ORDER BY n DESC, cc_num LIMIT 1")
def busiest_card(spark, sf_dir):
    return txn(spark, sf_dir).groupBy("cc_num").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "cc_num").limit(1)


@query(
    "tk07_cheapest_threshold",
    f"WITH {S.SCORED}, th AS (SELECT CAST(range AS INTEGER) AS threshold FROM range(1, 100)), x AS (SELECT * FROM scored, th)"
    + S.confusion("x", "hybrid_score >= threshold", by="threshold")
    + f", c AS (SELECT threshold, tp, fp, fn, tn, {S.costs('5')} FROM cm) SELECT threshold, tp, fp, fn, tn, total_cost FROM c ORDER BY total_cost, threshold LIMIT 1",
)
def cheapest_threshold(spark, sf_dir):
    return cheapest(sweep(scored(spark, sf_dir), "hybrid_score")).select("threshold", "tp", "fp", "fn", "tn", "total_cost")


_MIX = "CASE config WHEN 0 THEN p_ml WHEN 1 THEN p_ml * 0.5::DOUBLE + s_anom / 200 ELSE s_anom / 100 END"


@query(
    "tk08_best_candidate",
    f"WITH {S.PROBS}, g(config) AS (VALUES (0), (1), (2)), m AS (SELECT config, is_fraud, {S.r(_MIX, 6)} AS score6 FROM probs CROSS JOIN g)"
    + S.curve("m", "score6", "config", "cv") + S.area("cv", "config", digits=9)
    + " SELECT config, pr_auc FROM area ORDER BY pr_auc DESC, config LIMIT 1",
)
def best_candidate(spark, sf_dir):
    df = with_weight_sets(probabilities(spark, sf_dir), [(0, 1.0, 0.0, 0.0), (1, 0.5, 0.5, 0.0), (2, 0.0, 1.0, 0.0)])
    mixed = F.when(F.col("config") == 0, F.col("p_ml")).when(
        F.col("config") == 1, F.col("p_ml") * 0.5 + F.col("s_anom") / 200.0
    ).otherwise(F.col("s_anom") / 100.0)
    return metrics.best_weights(df, mixed)


@query(
    "tk09_error_samples",
    f"""WITH {S.PROBS}, e AS (SELECT trans_num, amt, category, CASE WHEN is_fraud = 0 AND p_ml >= 0.3 THEN 'fp' WHEN is_fraud = 1 AND p_ml < 0.3 THEN 'fn' END AS outcome FROM probs)
    SELECT outcome, trans_num, amt, category, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY trans_num) AS place FROM e WHERE outcome IS NOT NULL) WHERE place <= 2""",
)
def error_samples(spark, sf_dir):
    out = metrics.error_samples(probabilities(spark, sf_dir), F.col("p_ml") >= 0.3)
    return out.select("outcome", "trans_num", "amt", "category", "place")
