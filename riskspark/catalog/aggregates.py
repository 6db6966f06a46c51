"""Profiles, summaries, histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.registry import query
from riskspark.catalog.views import components, features, probabilities, scored, txn, txn_dirty
from riskspark.config import FEATURES
from riskspark.functions.numeric import half_even
from riskspark.operators import features as FE
from riskspark.operators import profile as P
from riskspark.operators.fusion import anomaly_flag
from riskspark.operators.quantiles import quantiles
from riskspark.operators.rules import BEHAVIOUR_SIGNALS, signal_counts
from riskspark.sources.fixtures import order_txn

COLUMNS = ("trans_num", "trans_ts", "cc_num", "category", "amt", "lat", "long", "merch_lat", "merch_long", "dob", "is_fraud")


@query(
    "ag01_global_baselines",
    f"WITH {S.TXN} SELECT {S.r('avg(amt)', 4)} AS global_mean, {S.r('quantile_cont(amt, 0.5)', 4)} AS global_median, {S.r('avg(is_fraud)', 6)} AS global_rate FROM txn",
)
def global_baselines(spark, sf_dir):
    return FE.global_baselines(txn(spark, sf_dir)).select(
        half_even(F.col("global_mean"), 4).alias("global_mean"), half_even(F.col("global_median"), 4).alias("global_median"),
        half_even(F.col("global_rate"), 6).alias("global_rate"),
    )


@query("ag02_card_mean", f"WITH {S.TXN} SELECT cc_num, {S.r('avg(amt)', 8)} AS card_mean, count(*) AS card_rows FROM txn GROUP BY cc_num")
def card_mean(spark, sf_dir):
    return FE.card_means(txn(spark, sf_dir)).withColumn("card_mean", half_even(F.col("card_mean"), 8))


@query("ag03_category_median", f"WITH {S.TXN} SELECT category, {S.r('quantile_cont(amt, 0.5)', 4)} AS category_median FROM txn GROUP BY category")
def category_median(spark, sf_dir):
    return FE.category_medians(txn(spark, sf_dir)).withColumn("category_median", half_even(F.col("category_median"), 4))


@query("ag03b_category_median_distributed", f"WITH {S.TXN} SELECT category, {S.r('quantile_cont(amt, 0.5)', 4)} AS category_median FROM txn GROUP BY category")
def category_median_distributed(spark, sf_dir):
    """The plan for groups too large for one task."""
    out = quantiles(txn(spark, sf_dir), "amt", {"category_median": 0.5}, by=("category",))
    return out.withColumn("category_median", half_even(F.col("category_median"), 4))


@query("ag04_category_fraud_rate", f"WITH {S.TXN} SELECT category, {S.r('avg(is_fraud)', 6)} AS category_rate, count(*) AS category_rows FROM txn GROUP BY category")
def category_rate(spark, sf_dir):
    return FE.category_rates(txn(spark, sf_dir)).withColumn("category_rate", half_even(F.col("category_rate"), 6))


_KIND = "CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof(any_value({c}))) END"


@query(
    "ag05_dataset_profile",
    f"WITH {S.TXN}, t AS (" + " UNION ALL ".join(f"SELECT count(*) AS row_count, '{c}' AS column_name, {_KIND.format(c=c)} AS data_type FROM txn" for c in COLUMNS)
    + """) SELECT row_count, CAST(count(*) OVER () AS INTEGER) AS column_count, column_name, data_type,
      CASE WHEN column_name = 'is_fraud' THEN 'target' WHEN data_type IN ('bigint', 'double', 'int') THEN 'numerical' ELSE 'categorical' END AS feature_kind FROM t""",
)
def dataset_profile(spark, sf_dir):
    return P.dataset_profile(txn(spark, sf_dir))


@query(
    "ag06_null_profile",
    f"WITH {S.DIRTY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_count, {S.r(S.pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)'), 3)} AS missing_percentage FROM dirty"
        for c in (*COLUMNS, "event_id", "copy_no")
    ),
)
def null_profile(spark, sf_dir):
    return P.null_profile(txn_dirty(spark, sf_dir))


@query(
    "ag07_duplicate_rows",
    f"WITH {S.DIRTY}, g AS (SELECT count(*) AS n FROM dirty GROUP BY {', '.join(COLUMNS)}, event_id) "
    f"SELECT CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows, {S.r(S.pct('sum(n) - count(*)', 'sum(n)'), 2)} AS duplicate_pct FROM g",
)
def duplicate_rows(spark, sf_dir):
    return P.duplicate_rows(txn_dirty(spark, sf_dir).drop("copy_no"))


@query(
    "ag08_cardinality",
    f"WITH {S.DIRTY} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM dirty" for c in (*COLUMNS, "event_id", "copy_no")),
)
def cardinality(spark, sf_dir):
    return P.cardinality(txn_dirty(spark, sf_dir))


@query(
    "ag09_class_distribution",
    f"""WITH {S.TXN}, c AS (SELECT count(*) FILTER (is_fraud = 0) AS l, count(*) FILTER (is_fraud = 1) AS f, count(*) AS n FROM txn)
    SELECT l AS legitimate_count, {S.r(S.pct('l', 'n'), 2)} AS legitimate_percent, f AS fraud_count, {S.r(S.pct('f', 'n'), 2)} AS fraud_percent,
      {S.r('l::DOUBLE / greatest(f, 1)', 2)} AS imbalance_ratio FROM c""",
)
def class_distribution(spark, sf_dir):
    return P.class_distribution(txn(spark, sf_dir))


def _q(p, c="amt"):
    return f"quantile_cont({c}, {p})"


@query(
    "ag10_amount_summary",
    f"WITH {S.TXN} SELECT {S.r('min(amt)', 4)} AS min, {S.r(_q(0.25), 4)} AS p25, {S.r(_q(0.5), 4)} AS median, {S.r('avg(amt)', 4)} AS mean, "
    f"{S.r(_q(0.75), 4)} AS p75, {S.r(_q(0.99), 4)} AS p99, {S.r('max(amt)', 4)} AS max FROM txn",
)
def amount_summary(spark, sf_dir):
    return P.amount_summary(txn(spark, sf_dir), digits=4)


_STATS = (
    f"{S.r('avg(amt)', 4)} AS mean, {S.r('stddev_samp(amt)', 4)} AS std, {S.r('min(amt)', 4)} AS min, "
    + ", ".join(f"{S.r(_q(p), 4)} AS {n}" for n, p in P.CLASS_PROBS.items())
    + f", {S.r('max(amt)', 4)} AS max"
)


@query("ag11_class_amount_stats", f"WITH {S.TXN} SELECT is_fraud, {_STATS} FROM txn GROUP BY is_fraud")
def class_amount_stats(spark, sf_dir):
    return P.class_amount_stats(txn(spark, sf_dir), digits=4)


@query(
    "ag11b_class_amount_ratios",
    f"WITH {S.TXN}, s AS (SELECT is_fraud, {_STATS} FROM txn GROUP BY is_fraud) SELECT "
    + ", ".join(f"{S.r(f'max({s}) FILTER (is_fraud = 1) / greatest(max({s}) FILTER (is_fraud = 0), 0.01::DOUBLE)', 2)} AS {s}_ratio" for s in ("mean", "median", "p95", "p99"))
    + " FROM s",
)
def class_amount_ratios(spark, sf_dir):
    return P.class_amount_ratios(P.class_amount_stats(txn(spark, sf_dir), digits=4))


@query(
    "ag12_iqr_tail",
    f"""WITH {S.TXN}, q AS (SELECT {_q(0.25)} AS q1, {_q(0.75)} AS q3 FROM txn WHERE is_fraud = 0), b AS (SELECT q3 + (q3 - q1) * 1.5::DOUBLE AS bound FROM q)
    SELECT is_fraud, {S.r('any_value(bound)', 2)} AS upper_bound, count(*) AS total_rows, count(*) FILTER (amt > bound) AS outliers,
      {S.r(S.pct('count(*) FILTER (amt > bound)', 'count(*)'), 2)} AS outlier_pct FROM txn CROSS JOIN b GROUP BY is_fraud""",
)
def iqr_tail(spark, sf_dir):
    return P.iqr_tail(txn(spark, sf_dir))


_NIGHT = "hour(trans_ts) <= 5"


@query(
    "ag13_night_day",
    f"""WITH {S.TXN}, c AS (SELECT count(*) FILTER ({_NIGHT}) AS night_total, count(*) FILTER ({_NIGHT} AND is_fraud = 1) AS night_fraud,
      count(*) FILTER (NOT {_NIGHT}) AS day_total, count(*) FILTER (NOT {_NIGHT} AND is_fraud = 1) AS day_fraud FROM txn)
    SELECT *, {S.r(S.pct('night_fraud', 'night_total'), 2)} AS night_rate_pct, {S.r(S.pct('day_fraud', 'day_total'), 2)} AS day_rate_pct,
      {S.r(S.pct('night_fraud', 'night_total') + ' / greatest(' + S.pct('day_fraud', 'day_total') + ', 0.01::DOUBLE)', 4)} AS relative_risk FROM c""",
)
def night_day(spark, sf_dir):
    return P.night_day(txn(spark, sf_dir))


_CATEGORY = f"""cs AS (SELECT category, count(*) AS total_transactions, CAST(sum(is_fraud) AS BIGINT) AS fraud_transactions,
  {S.r('avg(is_fraud) * 100', 2)} AS fraud_rate_pct, {S.r('avg(amt)', 2)} AS mean_amount FROM txn GROUP BY category),
cl AS (SELECT *, CASE WHEN fraud_rate_pct > 2 THEN 'HIGH' WHEN fraud_rate_pct > 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_label FROM cs)"""


@query("ag14_category_summary", f"WITH {S.TXN}, {_CATEGORY} SELECT * FROM cl")
def category_summary(spark, sf_dir):
    return P.category_summary(txn(spark, sf_dir))


@query(
    "ag15_hourly_profile",
    f"WITH {S.TXN} SELECT CAST(hour(trans_ts) AS INTEGER) AS hour, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud, {S.r('avg(is_fraud) * 100', 4)} AS rate_pct FROM txn GROUP BY 1",
)
def hourly_profile(spark, sf_dir):
    return P.hourly_profile(txn(spark, sf_dir))


CORRELATIONS = " UNION ALL ".join(f"SELECT '{f}' AS feature, {S.r(f'corr({f}, is_fraud)', 4)} AS correlation FROM feat" for f in FEATURES)


@query("ag16_label_correlations", f"WITH {S.TXN}{S.features()} {CORRELATIONS}")
def label_correlations(spark, sf_dir):
    return P.label_correlations(features(spark, sf_dir))


_MATRIX = (*FEATURES, "is_fraud")


@query(
    "ag17_correlation_matrix",
    f"WITH {S.TXN}{S.features()} "
    + " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {S.r(f'corr({a}, {b})', 4)} AS correlation FROM feat" for a in _MATRIX for b in _MATRIX),
)
def correlation_matrix(spark, sf_dir):
    return P.correlation_matrix(features(spark, sf_dir))


@query(
    "ag18_log_histogram",
    f"""WITH {S.TXN}, e AS (SELECT log10(greatest(min(amt), 1)) AS lo, (log10(max(amt)) - log10(greatest(min(amt), 1))) / 39 AS step FROM txn),
    b AS (SELECT is_fraud, lo, step, CAST(least(floor((log10(amt) - lo) / step), 38) AS INTEGER) AS bin FROM txn CROSS JOIN e WHERE amt > 0 AND log10(amt) >= lo),
    c AS (SELECT is_fraud, bin, count(*) AS n, any_value(power(10::DOUBLE, lo + bin * step)) AS low, any_value(power(10::DOUBLE, lo + (bin + 1) * step)) AS high FROM b GROUP BY is_fraud, bin),
    t AS (SELECT is_fraud, sum(n) AS total FROM c GROUP BY is_fraud)
    SELECT is_fraud, bin, n, {S.r('low', 4)} AS low, {S.r('high', 4)} AS high, {S.r('n / (total * (high - low))', 8)} AS density FROM c JOIN t USING (is_fraud)""",
)
def log_histogram(spark, sf_dir):
    return P.log_histogram(txn(spark, sf_dir))


@query(
    "ag19_score_histogram",
    f"WITH {S.PROBS} SELECT is_fraud, CAST(least(floor(s_anom / 2.5::DOUBLE), 39) AS INTEGER) AS bin, count(*) AS n FROM probs GROUP BY ALL",
)
def score_histogram(spark, sf_dir):
    return P.linear_histogram(probabilities(spark, sf_dir), "s_anom", bins=40)


@query(
    "ag20_box_plot",
    f"""WITH {S.TXN}, q AS (SELECT is_fraud, {_q(0.25)} AS q1, {_q(0.5)} AS median, {_q(0.75)} AS q3 FROM txn GROUP BY is_fraud),
    x AS (SELECT *, amt >= q1 - (q3 - q1) * 1.5::DOUBLE AND amt <= q3 + (q3 - q1) * 1.5::DOUBLE AS inside FROM txn JOIN q USING (is_fraud))
    SELECT is_fraud, {S.r('any_value(q1)', 4)} AS q1, {S.r('any_value(median)', 4)} AS median, {S.r('any_value(q3)', 4)} AS q3,
      {S.r('min(amt) FILTER (inside)', 4)} AS whisker_low, {S.r('max(amt) FILTER (inside)', 4)} AS whisker_high, {S.r('avg(amt)', 4)} AS mean,
      count(*) FILTER (NOT inside) AS outliers FROM x GROUP BY is_fraud""",
)
def box_plot(spark, sf_dir):
    return P.box_plot(txn(spark, sf_dir), "amt", ("is_fraud",))


_PROFILE = (
    f"ap AS (SELECT CAST(s_anom >= 65 AS INTEGER) AS is_anomalous, count(*) AS rows, {S.r('avg(amt)', 2)} AS mean_amount, {S.r(_q(0.5), 2)} AS median_amount, "
    f"{S.r('avg(haversine_distance_km)', 2)} AS mean_distance_km, {S.r('avg(amt_to_user_avg_ratio)', 2)} AS mean_user_ratio, "
    f"{S.r('avg(is_fraud) * 100', 2)} AS fraud_rate_pct FROM probs GROUP BY 1)"
)


def _flagged(spark, sf_dir):
    return probabilities(spark, sf_dir).withColumn("is_anomalous", anomaly_flag(F.col("s_anom")))


@query("ag21_anomaly_profile", f"WITH {S.PROBS}, {_PROFILE} SELECT * FROM ap")
def anomaly_profile(spark, sf_dir):
    return P.anomaly_profile(_flagged(spark, sf_dir))


_GUARDS = {"mean_amount": 1, "median_amount": 1, "mean_distance_km": 1, "mean_user_ratio": 0.01, "fraud_rate_pct": 0.01}


@query(
    "ag21b_anomaly_multipliers",
    f"WITH {S.PROBS}, {_PROFILE} SELECT "
    + ", ".join(f"{S.r(f'max({c}) FILTER (is_anomalous = 1) / greatest(max({c}) FILTER (is_anomalous = 0), {g}::DOUBLE)', 2)} AS {c}_x" for c, g in _GUARDS.items())
    + " FROM ap",
)
def anomaly_multipliers(spark, sf_dir):
    return P.anomaly_multipliers(P.anomaly_profile(_flagged(spark, sf_dir)))


_BANDS = (("0-25", "s_anom >= 0 AND s_anom <= 25"), ("25-50", "s_anom > 25 AND s_anom <= 50"), ("50-75", "s_anom > 50 AND s_anom <= 75"), ("75-100", "s_anom > 75 AND s_anom <= 100"))


@query(
    "ag22_band_rates",
    f"WITH {S.PROBS}, b AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS band, count(*) FILTER ({c}) AS total, count(*) FILTER ({c} AND is_fraud = 1) AS fraud FROM probs" for n, c in _BANDS)
    + f") SELECT *, {S.r(S.pct('fraud', 'total'), 4)} AS rate_pct FROM b",
)
def band_rates(spark, sf_dir):
    return P.band_rates(probabilities(spark, sf_dir), "s_anom")


TIER_ALLOCATION = (
    "t(risk_level) AS (VALUES ('LOW RISK'), ('MEDIUM RISK'), ('HIGH RISK')), "
    "a AS (SELECT t.risk_level, count(s.trans_num) AS total, count(s.trans_num) FILTER (s.is_fraud = 1) AS fraud_count FROM t LEFT JOIN scored s USING (risk_level) GROUP BY 1)"
)


@query("ag23_tier_allocation", f"WITH {S.SCORED}, {TIER_ALLOCATION} SELECT *, {S.r(S.pct('fraud_count', 'total'), 2)} AS fraud_rate_pct FROM a")
def tier_allocation(spark, sf_dir):
    return P.tier_allocation(scored(spark, sf_dir))


@query(
    "ag24_signal_counts",
    f"WITH {S.TXN}{S.features()}{S.SEVERITIES} "
    + " UNION ALL ".join(
        f"SELECT '{r.name}' AS signal, count(s{i}) AS triggered_rows, count(*) FILTER (behavioral_score >= {r.weight}) AS score_reaches_weight FROM sig"
        for i, r in enumerate(BEHAVIOUR_SIGNALS, 1)
    ),
)
def signals(spark, sf_dir):
    return signal_counts(features(spark, sf_dir))


@query(
    "ag25_source_levels",
    f"WITH {S.COMPONENTS} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS source, {S.r(f'avg({c})', 2)} AS mean_score, {S.r(f'max({c})', 2)} AS max_score FROM comp"
        for n, c in (("supervised", "p_ml * 100"), ("anomaly", "s_anom"), ("behaviour", "behavioral_score"))
    ),
)
def source_levels(spark, sf_dir):
    return P.source_levels(
        components(spark, sf_dir), {"supervised": F.col("p_ml") * 100.0, "anomaly": F.col("s_anom"), "behaviour": F.col("behavioral_score")}
    )


@query(
    "ag26_order_amount_histogram",
    f"""WITH {S.ORDERS}, m AS (SELECT max(amt) AS hi FROM otxn) SELECT category, CAST(least(floor(amt / (hi / 50)), 49) AS INTEGER) AS bin, count(*) AS n
    FROM otxn CROSS JOIN m GROUP BY ALL""",
)
def order_histogram(spark, sf_dir):
    """Linear histogram per segment on the second source; the top edge is the maximum."""
    df = order_txn(spark, sf_dir)
    width = df.agg(F.max("amt") / 50).scalar()
    at = F.least(F.floor(F.col("amt") / width), F.lit(49)).cast("int")
    return df.groupBy("category", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
