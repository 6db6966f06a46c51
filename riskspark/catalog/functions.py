"""Scalar functions: geography, calendar, ratios, rules, signals, fusion, wording."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.registry import query
from riskspark.catalog.views import components, features, probabilities, txn, txn_dense, with_surrogates
from riskspark.catalog.windows import CONTRIBUTIONS, contributed
from riskspark.config import FEATURES, FROZEN_FUSION, LIVE_FUSION, UNIT_FUSION
from riskspark.functions import calendar, text
from riskspark.functions.geo import haversine_km
from riskspark.functions.numeric import half_even
from riskspark.operators import fusion
from riskspark.operators.features import Baselines, add_features, row_features
from riskspark.operators.quantiles import quantiles
from riskspark.operators.rules import BEHAVIOUR_SIGNALS, WEIGHTED_RULES, apply_rules, apply_signals, fired

FEAT = S.TXN + S.features()


@query("sc01_haversine", f"WITH {S.TXN}{S.distance('txn')} SELECT trans_num, {S.r('haversine_distance_km', 6)} AS km FROM dist")
def haversine(spark, sf_dir):
    km = haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    return txn(spark, sf_dir).select("trans_num", half_even(km, 6).alias("km"))


@query(
    "sc02_calendar",
    f"""WITH {S.TXN} SELECT trans_num, CAST(hour(trans_ts) AS INTEGER) AS hour, CAST(isodow(trans_ts) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN hour(trans_ts) < 6 THEN 1 ELSE 0 END AS is_night FROM txn""",
)
def calendar_parts(spark, sf_dir):
    ts = F.col("trans_ts")
    return txn(spark, sf_dir).select(
        "trans_num", F.hour(ts).alias("hour"), calendar.monday_weekday(ts).alias("day_of_week"), calendar.is_night(F.hour(ts)).alias("is_night")
    )


@query(
    "sc03_age",
    f"WITH {S.TXN} SELECT trans_num, least(greatest(coalesce((year(trans_ts) - year(dob))::DOUBLE, 40), 18), 100) AS age FROM txn",
)
def age(spark, sf_dir):
    return txn(spark, sf_dir).select("trans_num", calendar.age_years(F.col("trans_ts"), F.col("dob")).alias("age"))


@query(
    "sc04_lenient_parsing",
    f"""WITH {S.TXN}, t AS (SELECT trans_num, strftime(trans_ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
      CASE WHEN trans_num::BIGINT % 9 = 0 THEN 'unknown' ELSE strftime(dob, '%Y-%m-%d') END AS dob_text FROM txn)
    SELECT trans_num, epoch_us(try_cast(ts_text AS TIMESTAMP)) AS ts_us, strftime(try_cast(dob_text AS DATE), '%Y-%m-%d') AS dob FROM t""",
)
def parsing(spark, sf_dir):
    broken = F.when(F.col("trans_num").cast("bigint") % 9 == 0, F.lit("unknown")).otherwise(F.date_format("dob", "yyyy-MM-dd"))
    texts = txn(spark, sf_dir).select("trans_num", F.date_format("trans_ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"), broken.alias("dob_text"))
    return texts.select(
        "trans_num", F.unix_micros(calendar.lenient_timestamp(F.col("ts_text"))).alias("ts_us"),
        F.date_format(calendar.lenient_date(F.col("dob_text")), "yyyy-MM-dd").alias("dob"),
    )


@query(
    "sc05_card_ratio",
    f"WITH {S.TXN}{S.baselines()} SELECT trans_num, {S.r('amt / (coalesce(card_mean, global_mean) + 1e-5)', 6)} AS ratio FROM txn LEFT JOIN cards USING (cc_num) CROSS JOIN gbase",
)
def card_ratio(spark, sf_dir):
    df = txn(spark, sf_dir)
    out = Baselines.fit(df).with_cards(df)
    return out.select("trans_num", half_even(F.col("amt") / (F.col("card_mean") + F.lit(1e-5)), 6).alias("ratio"))


@query(
    "sc06_category_ratio",
    f"WITH {S.TXN}{S.baselines()} SELECT trans_num, {S.r('amt / (coalesce(category_median, global_median) + 1e-5)', 6)} AS ratio FROM txn LEFT JOIN cats USING (category) CROSS JOIN gbase",
)
def category_ratio(spark, sf_dir):
    df = txn(spark, sf_dir)
    out = Baselines.fit(df).with_categories(df)
    return out.select("trans_num", half_even(F.col("amt") / (F.col("category_median") + F.lit(1e-5)), 6).alias("ratio"))


RULE_SQL = {
    "R1_EXTREME_AMOUNT": "amt >= 1500 AND amt_to_user_avg_ratio >= 4",
    "R2_VELOCITY_SPIKE": "trans_velocity_1h >= 3",
    "R3_IMPOSSIBLE_TRAVEL": "haversine_distance_km >= 800",
    "R4_LATE_NIGHT_HIGH_VALUE": "is_night_transaction = 1 AND amt_to_cat_median_ratio >= 3",
    "R5_HIGH_RISK_CATEGORY": "lower(category) IN ('shopping_net', 'misc_net', 'shopping_pos') AND amt >= 500",
}
_RULE_KEYS = ("sc07_rule_extreme_amount", "sc08_rule_velocity", "sc09_rule_travel", "sc10_rule_late_night", "sc11_rule_risky_category")


def _register_rule(key, rule):
    dense = rule.rule_id == "R2_VELOCITY_SPIKE"  # bursts of three only occur on the dense cards
    if dense:
        sql = f"WITH {S.DENSE}{S.velocity('dense', 'feat')} SELECT trans_num FROM feat WHERE {RULE_SQL[rule.rule_id]}"
    else:
        sql = f"WITH {FEAT} SELECT trans_num FROM feat WHERE {RULE_SQL[rule.rule_id]}"

    @query(key, sql)
    def rule_rows(spark, sf_dir):
        if dense:
            from riskspark.operators.velocity import card_velocity

            df = card_velocity(txn_dense(spark, sf_dir).select("trans_num", "trans_ts", "cc_num", "amt"))
        else:
            df = features(spark, sf_dir, velocity=False)
        return df.where(fired(df, rule)).select("trans_num")


for _key, _rule in zip(_RULE_KEYS, WEIGHTED_RULES):
    _register_rule(_key, _rule)

_RULE_SCORE = "least(1::DOUBLE, " + " + ".join(f"CASE WHEN {RULE_SQL[r.rule_id]} THEN {r.weight!r}::DOUBLE ELSE 0::DOUBLE END" for r in WEIGHTED_RULES) + ")"
_RULE_LIST = "concat_ws(',', " + ", ".join(f"CASE WHEN {RULE_SQL[r.rule_id]} THEN '{r.rule_id}' END" for r in WEIGHTED_RULES) + ")"
_RULE_COUNT = "CAST(" + " + ".join(f"({RULE_SQL[r.rule_id]})::INT" for r in WEIGHTED_RULES) + " AS INTEGER)"


@query("sc12_rule_engine", f"WITH {FEAT} SELECT trans_num, {S.r(_RULE_SCORE, 4)} AS rule_score, {_RULE_LIST} AS rules, {_RULE_COUNT} AS rule_count FROM feat")
def rule_engine(spark, sf_dir):
    out = apply_rules(features(spark, sf_dir))
    return out.select("trans_num", "rule_score", F.array_join("triggered_rules.rule_id", ",").alias("rules"), "rule_count")


SIG = FEAT + S.SEVERITIES
_MESSAGES = (
    f"'Transaction amount ($' || {S.fixed('amt', 2)} || ') exceeds $500 and is ' || {S.fixed('amt_to_cat_median_ratio', 1)} || 'x the category median.'",
    f"'Order value is ' || {S.fixed('amt_to_user_avg_ratio', 1)} || 'x higher than this cardholder''s baseline average spend.'",
    f"'Terminal location is ' || {S.fixed('haversine_distance_km', 1)} || ' km away from registered billing address.'",
    "'Card velocity spike: ' || trans_velocity_1h || ' txns in last hour, ' || trans_velocity_24h || ' txns in 24 hours.'",
    "'Transaction authorized during vulnerable midnight-to-dawn window (12 AM - 5 AM).'",
    f"'High nominal order ($' || {S.fixed('amt', 2)} || ') placed in elevated chargeback sector ''' || lower(category) || '''.'",
)
_SIGNAL_KEYS = (
    "sc13_signal_amount", "sc14_signal_spike", "sc15_signal_distance", "sc16_signal_velocity", "sc17_signal_night", "sc18_signal_category",
)


def _register_signal(key, i, rule):
    @query(key, f"WITH {SIG} SELECT trans_num, {S.r(f's{i}', 2)} AS severity, {_MESSAGES[i - 1]} AS explanation FROM sig WHERE s{i} IS NOT NULL")
    def signal_rows(spark, sf_dir):
        df = features(spark, sf_dir, velocity=rule.rule_id == "SIG_VELOCITY_BURST")
        found = apply_signals(df, (rule,)).where("signal_count = 1")
        return found.select("trans_num", F.col("signals")[0]["severity"].alias("severity"), F.col("signals")[0]["explanation"].alias("explanation"))


for _i, (_key, _rule) in enumerate(zip(_SIGNAL_KEYS, BEHAVIOUR_SIGNALS), 1):
    _register_signal(_key, _i, _rule)


@query("sc19_behaviour_score", f"WITH {SIG} SELECT trans_num, behavioral_score, signal_count, signal_names FROM sig")
def behaviour_score(spark, sf_dir):
    out = apply_signals(features(spark, sf_dir))
    return out.select("trans_num", "behavioral_score", "signal_count", F.array_join("signals.signal", "; ").alias("signal_names"))


@query(
    "sc20_weight_normalization",
    f"""WITH {S.TXN}, w AS (SELECT category, count(*)::DOUBLE AS a, sum(is_fraud)::DOUBLE + 1 AS b, avg(amt) AS c FROM txn GROUP BY category)
    SELECT category, {S.r('a / (a + b + c)', 6)} AS w_ml, {S.r('b / (a + b + c)', 6)} AS w_anomaly, {S.r('c / (a + b + c)', 6)} AS w_rules FROM w""",
)
def weight_normalization(spark, sf_dir):
    """Unnormalized weights (here: volume, frauds and mean amount per category) to shares."""
    w = txn(spark, sf_dir).groupBy("category").agg(
        F.count(F.lit(1)).cast("double").alias("a"), (F.sum("is_fraud") + 1).cast("double").alias("b"), F.avg("amt").alias("c")
    )
    shares = fusion.normalized(F.col("a"), F.col("b"), F.col("c"))
    return w.select("category", *[half_even(s, 6).alias(n) for s, n in zip(shares, ("w_ml", "w_anomaly", "w_rules"))])


_LIVE_T = 0.65 + 0.20 + 0.15
_LIVE_W = [f"{w / _LIVE_T!r}::DOUBLE" for w in (0.65, 0.20, 0.15)]
_UNIT_T = 0.60 + 0.15 + 0.25
_UNIT_W = [f"{w / _UNIT_T!r}::DOUBLE" for w in (0.60, 0.15, 0.25)]


@query(
    "sc21_fused_score",
    f"""WITH {S.COMPONENTS} SELECT trans_num, {S.fused(*_LIVE_W)} AS live_score,
    CAST(least(greatest(round_even(({_UNIT_W[0]} * p_ml + {_UNIT_W[1]} * (s_anom / 100) + {_UNIT_W[2]} * {S.r(_RULE_SCORE, 4)}) * 100, 0), 0), 100) AS INTEGER) AS unit_score FROM comp""",
)
def fused_score(spark, sf_dir):
    df = apply_rules(components(spark, sf_dir))
    live = fusion.fuse(F.col("p_ml"), F.col("s_anom"), F.col("behavioral_score"), fusion.config_weights(LIVE_FUSION))
    unit = fusion.fuse_unit(F.col("p_ml"), F.col("s_anom") / 100.0, F.col("rule_score"), fusion.config_weights(UNIT_FUSION))
    return df.select("trans_num", live.alias("live_score"), unit.alias("unit_score"))


def _actions(cfg, score):
    low, medium, high = cfg.actions
    return f"CASE WHEN {score} <= {cfg.low_max} THEN '{low}' WHEN {score} <= {cfg.medium_max} THEN '{medium}' ELSE '{high}' END"


@query(
    "sc22_tier_action",
    f"WITH {S.SCORED} SELECT trans_num, hybrid_score, risk_level, {_actions(FROZEN_FUSION, 'hybrid_score')} AS recommended_action, "
    f"{S.tier(medium='70')} AS unit_level, {_actions(UNIT_FUSION, 'hybrid_score')} AS unit_action FROM scored",
)
def tier_action(spark, sf_dir):
    df = fusion.apply_fusion(with_surrogates(apply_signals(features(spark, sf_dir), details=False)), FROZEN_FUSION)
    score = F.col("hybrid_score")
    return df.select(
        "trans_num", "hybrid_score", "risk_level", "recommended_action",
        fusion.tier(score, F.lit(UNIT_FUSION.low_max), F.lit(UNIT_FUSION.medium_max)).alias("unit_level"),
        fusion.action(score, UNIT_FUSION).alias("unit_action"),
    )


@query(
    "sc23_score_breakdown",
    f"WITH {S.SCORED} SELECT trans_num, 50.0::DOUBLE AS ml_weight_pct, {S.r('0.5::DOUBLE * (p_ml * 100)', 2)} AS ml_contribution, "
    f"{S.r('0.25::DOUBLE * s_anom', 2)} AS anomaly_contribution, {S.r('0.25::DOUBLE * behavioral_score', 2)} AS behavioral_contribution, hybrid_score FROM scored",
)
def breakdown(spark, sf_dir):
    out = fusion.score_breakdown(components(spark, sf_dir), FROZEN_FUSION)
    names = ("ml_weight_pct", "ml_contribution", "anomaly_contribution", "behavioral_contribution", "hybrid_score")
    return out.select("trans_num", *[F.col(f"score_breakdown.{n}").alias(n) for n in names])


_SHORT = """CASE WHEN signal_count > 0 THEN 'Flagged by ' || signal_count || ' risk signal(s): ' || signal_names
  WHEN hybrid_score >= 50 THEN 'Elevated statistical anomaly detected by unsupervised models.'
  ELSE 'Transaction behavior aligns with routine customer spending patterns.' END"""


@query("sc24_short_reason", f"WITH {S.SCORED} SELECT trans_num, {_SHORT} AS reason FROM scored")
def short_reason(spark, sf_dir):
    df = fusion.apply_fusion(components(spark, sf_dir), FROZEN_FUSION)
    return df.select("trans_num", fusion.short_reason(F.col("signals"), F.col("hybrid_score")).alias("reason"))


_FIRST_TWO = "array_to_string(string_split(signal_names, '; ')[1:2], ', ')"
REASONS = f"""coalesce(nullif(concat_ws(' | ',
    CASE WHEN p_ml >= 0.70::DOUBLE THEN 'High fraud probability (' || {S.fixed('p_ml * 100', 1)} || '%) from supervised ML model.' END,
    CASE WHEN s_anom >= 65 THEN 'Transaction behavior is statistically unusual (Anomaly Score: ' || {S.fixed('s_anom', 0)} || '/100).' END,
    CASE WHEN signal_count > 0 THEN 'Triggered behavioral risk rules (' || {_FIRST_TWO} || ').' END), ''),
  CASE WHEN hybrid_score <= 35 THEN 'Transaction conforms to typical historical patterns across all dimensions.'
       ELSE 'Elevated cumulative variance across multiple moderate risk signals.' END)"""


@query("sc25_reason_list", f"WITH {S.SCORED} SELECT trans_num, {REASONS} AS reasons FROM scored")
def reasons(spark, sf_dir):
    df = fusion.apply_fusion(components(spark, sf_dir), FROZEN_FUSION)
    listed = fusion.reason_list(F.col("p_ml"), F.col("s_anom"), F.col("signals"), F.col("hybrid_score"))
    return df.select("trans_num", F.array_join(listed, " | ").alias("reasons"))


_NAMES = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in text.DISPLAY_NAMES.items()) + " END"


@query(
    "sc26_display_names",
    f"""WITH {CONTRIBUTIONS}, f AS (SELECT feature, count(*) AS rows FROM con GROUP BY feature UNION ALL SELECT 'merchant_risk_index', count(*) FROM txn)
    SELECT feature, coalesce({_NAMES}, 'Merchant Risk Index') AS display_name, rows FROM f""",
)
def display_names(spark, sf_dir):
    names = contributed(spark, sf_dir).select(F.explode("contributions.feature").alias("feature"))
    other = txn(spark, sf_dir).select(F.lit("merchant_risk_index").alias("feature"))
    counted = names.unionByName(other).groupBy("feature").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("feature", text.display_name(F.col("feature")).alias("display_name"), "rows")


def _sentence_sql() -> str:
    forms = {"{v1}": S.fixed("value", 1), "{v2}": S.fixed("value", 2), "{vi}": "CAST(trunc(value) AS BIGINT)::VARCHAR", "{p2}": S.fixed("value * 100", 2)}

    def fill(template: str) -> str:
        out = "'" + template.replace("'", "''") + "'"
        for mark, expr in forms.items():
            out = out.replace(mark, f"' || {expr} || '")
        return out

    direction = "CASE WHEN contribution > 0 THEN 'elevated fraud risk' ELSE 'reduced risk (protective)' END"
    cases = [f"WHEN feature = '{f}' THEN CASE WHEN contribution > 0 THEN {fill(up)} ELSE {fill(down)} END" for f, (up, down) in text.SENTENCES.items()]
    cases.append(
        f"WHEN feature = 'is_night_transaction' THEN CASE WHEN value = 1 AND contribution > 0 THEN '{text.NIGHT_RAISING}' "
        f"ELSE replace('{text.NIGHT_OTHER}', '{{d}}', {direction}) END"
    )
    return f"CASE {' '.join(cases)} ELSE {_NAMES} || ' = ' || {S.fixed('value', 2)} || ' (' || {direction} || ').' END"


@query("sc27_feature_sentences", f"WITH {CONTRIBUTIONS} SELECT trans_num, feature, {_sentence_sql()} AS sentence FROM con")
def sentences(spark, sf_dir):
    rows = contributed(spark, sf_dir).select("trans_num", F.inline("contributions"))
    return rows.select("trans_num", "feature", text.feature_sentence(F.col("feature"), F.col("value"), F.col("contribution")).alias("sentence"))


_DRIVERS = f"""concat_ws(', ',
  CASE WHEN haversine_distance_km > 300 THEN 'large geographical jump (' || {S.fixed('haversine_distance_km', 0)} || ' km)' END,
  CASE WHEN amt_to_user_avg_ratio > 3 THEN 'atypical spending surge (' || {S.fixed('amt_to_user_avg_ratio', 1)} || 'x user average)' END,
  CASE WHEN amt > 500 THEN 'abnormally large order value ($' || {S.fixed('amt', 2)} || ')' END,
  CASE WHEN is_night_transaction = 1 THEN 'late-night authorization' END)"""
ANOMALY_REASON = f"""CASE WHEN s_anom >= 70 THEN CASE WHEN {_DRIVERS} <> '' THEN '{text.SEVERE_DRIVEN}' || {_DRIVERS} || '.' ELSE '{text.SEVERE_PLAIN}' END
  WHEN s_anom >= 40 THEN '{text.MILD}' ELSE '{text.ROUTINE}' END"""


@query("sc28_anomaly_reason", f"WITH {FEAT}{S.surrogates('feat', 'comp')} SELECT trans_num, {ANOMALY_REASON} AS reason FROM comp")
def anomaly_reason(spark, sf_dir):
    df = with_surrogates(features(spark, sf_dir, velocity=False))
    names = ("s_anom", "haversine_distance_km", "amt_to_user_avg_ratio", "amt", "is_night_transaction")
    return df.select("trans_num", text.anomaly_reason(*[F.col(c) for c in names]).alias("reason"))


_RAW = "-least(1::DOUBLE, haversine_distance_km / 5000)"
CALIBRATED = f"""raws AS (SELECT *, {_RAW} AS raw FROM dist), q AS (SELECT quantile_cont(raw, 0.005) AS lo, quantile_cont(raw, 0.995) AS hi0 FROM raws),
q2 AS (SELECT lo, CASE WHEN hi0 <= lo THEN lo + 1 ELSE hi0 END AS hi FROM q),
cal AS (SELECT r.*, {S.r('least(greatest((hi - raw) / (hi - lo + 1e-6), 0), 1) * 100', 2)} AS score FROM raws r CROSS JOIN q2)"""


def calibrated(spark, sf_dir):
    """A raw score that falls with distance, calibrated on its own 0.5 and 99.5 percentiles."""
    from riskspark.ml.iforest import calibration_bounds

    raw = -F.least(F.lit(1.0), haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")) / 5000.0)
    df = txn(spark, sf_dir, parse_once=True).withColumn("raw", raw)
    bounds = calibration_bounds(df, "raw").select(F.struct("*")).scalar()
    return df.withColumn("_b", bounds).withColumn("score", fusion.calibrate_anomaly(F.col("raw"), F.col("_b.low"), F.col("_b.high"))).drop("_b")


@query("sc29_anomaly_calibration", f"WITH {S.TXN}{S.distance('txn')}, {CALIBRATED} SELECT trans_num, score FROM cal")
def calibration(spark, sf_dir):
    return calibrated(spark, sf_dir).select("trans_num", "score")


@query("sc30_anomaly_flag", f"WITH {S.PROBS} SELECT trans_num, CAST(s_anom >= 65 AS INTEGER) AS is_anomalous FROM probs")
def flag(spark, sf_dir):
    return probabilities(spark, sf_dir).select("trans_num", fusion.anomaly_flag(F.col("s_anom")).alias("is_anomalous"))


@query("sc31_probability_class", f"WITH {S.PROBS} SELECT trans_num, CAST(p_ml >= 0.4::DOUBLE AS INTEGER) AS predicted FROM probs")
def probability_class(spark, sf_dir):
    return probabilities(spark, sf_dir).select("trans_num", fusion.class_at(F.col("p_ml"), 0.4).alias("predicted"))


@query(
    "sc32_money_text",
    f"WITH {S.PROBS} SELECT trans_num, '$' || format('{{:,.2f}}', {S.r('amt', 2)}) AS amount, {S.fixed('p_ml * 100', 1)} || '%' AS probability FROM probs",
)
def money(spark, sf_dir):
    return probabilities(spark, sf_dir).select(
        "trans_num", text.money_text(F.col("amt")).alias("amount"), text.percent_text(F.col("p_ml")).alias("probability")
    )
