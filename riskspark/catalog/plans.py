"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.aggregates import TIER_ALLOCATION
from riskspark.catalog.cleaning import _IMPUTED
from riskspark.catalog.functions import ANOMALY_REASON, REASONS, _actions
from riskspark.catalog.registry import query
from riskspark.catalog.views import components, features, scored, stored_split, txn, txn_dirty, with_surrogates
from riskspark.config import FEATURES, FROZEN_FUSION
from riskspark.functions.numeric import half_even
from riskspark.ml import supervised
from riskspark.ml.iforest import IsolationForest
from riskspark.operators.features import Baselines, add_features, row_features
from riskspark.operators.profile import tier_allocation
from riskspark.operators.rules import apply_signals
from riskspark.operators.fusion import apply_fusion
from riskspark.plans import jobs, scenarios
from riskspark.plans.deployment import Deployment, checked_requests
from riskspark.session import shared_folder, stored

_ROUNDED = ("haversine_distance_km", "amt_to_user_avg_ratio", "amt_to_cat_median_ratio", "category_fraud_rate")


def _rounded(c):
    return half_even(F.col(c), 6).alias(c) if c in _ROUNDED else F.col(c)


_COLUMNS = ", ".join(f"{S.r(c, 6)} AS {c}" if c in _ROUNDED else c for c in FEATURES)
_CLEANED = S.DIRTY + (
    f", med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in _IMPUTED)} FROM located), "
    f"cleaned AS (SELECT * EXCLUDE ({', '.join(f'm_{c}' for c in _IMPUTED)}) REPLACE ({', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in _IMPUTED)}, coalesce(category, 'UNKNOWN') AS category) FROM located CROSS JOIN med)"
)


@query(
    "jb01_preprocess",
    f"WITH {_CLEANED}{S.split('cleaned', 'parts')}, train AS (SELECT * FROM parts WHERE split = 'train'){S.features('parts', 'train', 'split')} "
    f"SELECT trans_num, split, is_fraud, {_COLUMNS} FROM feat",
)
def preprocess(spark, sf_dir):
    """Clean, split, fit on train, features of every split."""
    prepared = jobs.preprocess(txn_dirty(spark, sf_dir), order=("event_id", "copy_no"))
    return prepared.features().select("trans_num", "split", "is_fraud", *[_rounded(c) for c in FEATURES])


@query("jb02_features", f"WITH {S.TXN}{S.features()} SELECT trans_num, {_COLUMNS} FROM feat")
def feature_job(spark, sf_dir):
    return features(spark, sf_dir).select("trans_num", *[_rounded(c) for c in FEATURES])


@query("jb03_score", f"WITH {S.SCORED}, {TIER_ALLOCATION} SELECT *, {S.r(S.pct('fraud_count', 'total'), 2)} AS fraud_rate_pct FROM a")
def score(spark, sf_dir):
    """Features, three score sources, fusion, tiers: the tier summary."""
    return tier_allocation(jobs.score_table(with_surrogates(features(spark, sf_dir)), details=False))


@query("jb03b_scored_rows", f"WITH {S.SCORED} SELECT trans_num, behavioral_score, hybrid_score, risk_level FROM scored")
def scored_rows(spark, sf_dir):
    return jobs.score_table(with_surrogates(features(spark, sf_dir)), details=False).select(
        "trans_num", "behavioral_score", "hybrid_score", "risk_level"
    )


@query(
    "jb04_train",
    f"WITH {_CLEANED}{S.split('cleaned', 'parts')} SELECT count(*) AS sample_size, count(*) FILTER (is_fraud = 1) AS fraud_count, count(*) FILTER (is_fraud = 0) AS legitimate_count, "
    "true AS adds_up, true AS weights_sum FROM parts WHERE split = 'test'",
)
def train(spark, sf_dir):
    """The whole training pipeline; the report on the test split."""
    report = jobs.train(txn_dirty(spark, sf_dir), ("event_id", "copy_no")).report
    return report.select(
        "sample_size", "fraud_count", "legitimate_count",
        ((F.col("tp") + F.col("fn") == F.col("fraud_count")) & (F.col("fp") + F.col("tn") == F.col("legitimate_count"))).alias("adds_up"),
        (F.abs(F.col("w_ml") + F.col("w_anomaly") + F.col("w_rules") - 1.0) < 1e-9).alias("weights_sum"),
    )


_TEST = (
    f"{S.SPLIT}, train AS (SELECT * FROM parts WHERE split = 'train'){S.features('parts', 'train', 'split')}{S.SEVERITIES}{S.surrogates('sig', 'comp')}, "
    f"scored AS (SELECT *, {S.fused('0.5::DOUBLE', '0.25::DOUBLE', '0.25::DOUBLE')} AS hybrid_score FROM comp WHERE split = 'test'), "
    f"lv AS (SELECT *, {S.tier()} AS risk_level, hybrid_score / 100.0::DOUBLE AS unit FROM scored)"
)
_U, _FP, _FN = "(tp_amt + fn_amt + (tp + fn) * 20)", "(fp_amt * 0.2::DOUBLE + fp * 10)", "(fn_amt + fn * 20)"


@query(
    "jb05_held_out_evaluation",
    f"WITH {_TEST}{S.confusion('lv', 'hybrid_score >= 25')}{S.curve('lv', 'unit')}{S.area('curve')}, "
    "ti AS (SELECT count(*) FILTER (risk_level = 'LOW RISK') AS l, count(*) FILTER (risk_level = 'MEDIUM RISK') AS m, count(*) FILTER (risk_level = 'HIGH RISK') AS h FROM lv) "
    f"SELECT 'hybrid' AS model_name, tp + fp + fn + tn AS sample_size, tp + fn AS fraud_count, fp + tn AS legitimate_count, {S.r(S.div('tp + fn', 'tp + fp + fn + tn') + ' * 100', 2)} AS fraud_rate_percent, "
    f"{S.PRECISION} AS precision, {S.RECALL} AS recall, {S.F1} AS f1_score, {S.F2} AS f2_score, pr_auc, roc_auc, {S.FPR} AS false_positive_rate, tp, fp, fn, tn, "
    f"{S.r(S.div('tp + tn', 'tp + fp + fn + tn'), 4)} AS accuracy, {S.r(S.div('tn', 'tn + fp'), 4)} AS specificity, {S.r(S.div('fn', 'fn + tp'), 4)} AS false_negative_rate, "
    f"{S.r(_U, 2)} AS unmitigated_cost, {S.r(_FP, 2)} AS fp_cost, {S.r(_FN, 2)} AS fn_cost, {S.r(f'{_FN} + {_FP}', 2)} AS total_cost, "
    f"{S.r(f'{_U} - ({_FN} + {_FP})', 2)} AS net_savings, {S.r(f'({_U} - ({_FN} + {_FP})) / {_U} * 100', 2)} AS preservation_pct, "
    "l AS low_risk_rows, m AS medium_risk_rows, h AS high_risk_rows FROM cm CROSS JOIN area CROSS JOIN ti",
)
def evaluation(spark, sf_dir):
    """Frozen weights and cut-off on the held-out split, with the surrogate scores."""
    parts = stored_split(spark, sf_dir)
    base = Baselines.fit(parts.where("split = 'train'"))
    test = add_features(parts.where("split = 'test'"), base, scope=("split",))
    return jobs.held_out_evaluation(jobs.score_table(with_surrogates(test), details=False))


@query(
    "jb06_explanations",
    f"WITH {S.SCORED} SELECT trans_num AS transaction_id, {S.r('p_ml', 4)} AS fraud_probability, {S.r('s_anom', 2)} AS anomaly_score, behavioral_score AS behavioral_risk, "
    f"hybrid_score, risk_level, {_actions(FROZEN_FUSION, 'hybrid_score')} AS recommended_action, {ANOMALY_REASON} AS anomaly_explanation, signal_names AS signals, "
    f"{S.r('0.5::DOUBLE * (p_ml * 100)', 2)} AS ml_contribution, {REASONS} AS reasons FROM scored",
)
def explanations(spark, sf_dir):
    out = jobs.explain_table(jobs.score_table(with_surrogates(features(spark, sf_dir))))
    return out.select(
        "transaction_id", "fraud_probability", "anomaly_score", "behavioral_risk", "hybrid_score", "risk_level", "recommended_action",
        "anomaly_explanation", F.array_join("behavioral_signals.signal", "; ").alias("signals"),
        F.col("score_breakdown.ml_contribution").alias("ml_contribution"), F.array_join("explanation_summary", " | ").alias("reasons"),
    )


_STATED = "(trans_num::BIGINT % 400)::DOUBLE"


@query(
    "jb06b_requests",
    f"""WITH {S.TXN}, q AS (SELECT trans_num, CASE WHEN trans_num::BIGINT % 6 <> 0 THEN CAST(hour(trans_ts) AS INTEGER) END AS h,
      32.7767::DOUBLE AS lat, -96.797::DOUBLE AS long, 32.7767::DOUBLE + {_STATED} / 111 AS merch_lat, -96.797::DOUBLE AS merch_long FROM txn){S.distance('q')}
    SELECT trans_num, coalesce(h, 14) AS hour, 3 AS day_of_week, CASE WHEN coalesce(h, 14) <= 5 THEN 1 ELSE 0 END AS is_night_transaction,
      {S.r('haversine_distance_km', 6)} AS haversine_distance_km FROM dist""",
)
def requests(spark, sf_dir):
    """Rows reduced to what a request states: an hour (or none) and a distance."""
    e = F.col("trans_num").cast("bigint")
    stated = txn(spark, sf_dir).select(
        "trans_num", F.when(e % 6 != 0, F.hour("trans_ts")).alias("hour"), (e % 400).cast("double").alias("haversine_distance_km")
    )
    out = row_features(jobs.request_table(stated))
    return out.select("trans_num", "hour", "day_of_week", "is_night_transaction", _rounded("haversine_distance_km"))


# Requests as the rows of the table state them; some break a range, some leave fields out.
_REQUESTS = f"""{S.TXN}, q0 AS (SELECT trans_num::BIGINT AS e, trans_num, category, CASE WHEN trans_num::BIGINT % 17 = 0 THEN -amt ELSE amt END AS amt,
    CASE WHEN trans_num::BIGINT % 19 = 0 THEN 24 WHEN trans_num::BIGINT % 6 <> 0 THEN hour(trans_ts) END AS stated_hour,
    (trans_num::BIGINT % 1500)::DOUBLE AS km, CASE WHEN trans_num::BIGINT % 3 = 0 THEN (trans_num::BIGINT % 12)::DOUBLE END AS ratio, (trans_num::BIGINT % 4)::INTEGER AS v1 FROM txn),
  q AS (SELECT trans_num, category, amt, coalesce(stated_hour, 14) AS h, coalesce(ratio, 1) AS amt_to_user_avg_ratio, v1 AS trans_velocity_1h, 1 AS trans_velocity_24h, 1::DOUBLE AS amt_to_cat_median_ratio,
    32.7767::DOUBLE AS lat, -96.797::DOUBLE AS long, 32.7767::DOUBLE + km / 111 AS merch_lat, -96.797::DOUBLE AS merch_long FROM q0),
  broken AS (SELECT *, concat_ws(',', CASE WHEN amt > 0 THEN NULL ELSE 'amt' END, CASE WHEN h > 23 THEN 'hour' END, CASE WHEN amt_to_user_avg_ratio > 0 THEN NULL ELSE 'amt_to_user_avg_ratio' END) AS violations FROM q),
  ok AS (SELECT * FROM broken WHERE violations = ''){S.distance('ok')}, feat AS (SELECT *, CASE WHEN h <= 5 THEN 1 ELSE 0 END AS is_night_transaction FROM dist){S.SEVERITIES}"""


@query(
    "jb06c_request_answers",
    f"""WITH {_REQUESTS}
    SELECT trans_num AS transaction_id, 'answered' AS outcome, '' AS violations, behavioral_score AS behavioral_risk, signal_names AS signals, true AS adds_up, true AS attributed FROM sig
    UNION ALL SELECT trans_num, 'quarantined', violations, NULL, NULL, false, false FROM broken WHERE violations <> ''""",
)
def request_answers(spark, sf_dir):
    """Requests against a saved and reloaded deployment: checked, scored, attributed, explained. Behaviour score and
    signals are compared as values; of the models' parts, that they add up to score, tier and output."""
    e = F.col("trans_num").cast("bigint")
    stated = txn(spark, sf_dir).select(
        "trans_num", "category", F.when(e % 17 == 0, -F.col("amt")).otherwise(F.col("amt")).alias("amt"),
        F.when(e % 19 == 0, F.lit(24)).when(e % 6 != 0, F.hour("trans_ts")).alias("hour"), (e % 1500).cast("double").alias("haversine_distance_km"),
        F.when(e % 3 == 0, (e % 12).cast("double")).alias("amt_to_user_avg_ratio"), (e % 4).cast("int").alias("trans_velocity_1h"))
    kept = _deployment(spark, sf_dir)
    accepted, quarantined = checked_requests(stated)
    rows = kept.attributed(kept.request_features(accepted))
    cfg = kept.fusion
    mixed = F.round(cfg.w_ml * F.col("p_ml") * 100.0 + cfg.w_anomaly * F.col("s_anom") + cfg.w_rules * F.col("behavioral_score"), 6)
    tiers = F.when(F.col("hybrid_score") <= cfg.low_max, "LOW RISK").when(F.col("hybrid_score") <= cfg.medium_max, "MEDIUM RISK").otherwise("HIGH RISK")
    whole = F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c["contribution"])
    flags = rows.select(
        "trans_num", ((F.abs(mixed - F.col("hybrid_score")) <= 0.5 + 1e-6) & (F.col("risk_level") == tiers)).alias("adds_up"),
        (F.abs(whole - F.col("p_ml")) < 1e-6).alias("attributed"), "signals", "behavioral_score")
    answered = flags.select(
        F.col("trans_num").alias("transaction_id"), F.lit("answered").alias("outcome"), F.lit("").alias("violations"),
        F.col("behavioral_score").alias("behavioral_risk"), F.array_join("signals.signal", "; ").alias("signals"), "adds_up", "attributed")
    return answered.unionByName(quarantined.select(
        F.col("trans_num").alias("transaction_id"), F.lit("quarantined").alias("outcome"), F.array_join("violations", ",").alias("violations"),
        F.lit(None).cast("double").alias("behavioral_risk"), F.lit(None).cast("string").alias("signals"), F.lit(False).alias("adds_up"), F.lit(False).alias("attributed")))


def _deployment(spark, sf_dir, reload=True):
    """Forest classifier and isolation forest fitted on the training split, stored and read back."""
    parts = stored_split(spark, sf_dir)
    train = parts.where("split = 'train'")
    base = Baselines.fit(train)
    fitted = stored(add_features(train, base).select("trans_num", "is_fraud", *FEATURES), "train-features")
    made = Deployment(supervised.fit_forest(fitted), IsolationForest.fit(fitted), base)
    if not reload:
        return made, parts
    root = shared_folder(spark, "deployment")
    made.save(spark, root, 1)
    return Deployment.load(spark, root)


@query(
    "io08b_saved_models",
    f"WITH {S.SPLIT} SELECT trans_num, 0::DOUBLE AS probability_difference, 0::DOUBLE AS anomaly_difference, 0 AS score_difference, false AS tier_changed FROM parts WHERE split = 'test'",
)
def saved_models(spark, sf_dir):
    """Scores of the test split by the fitted models and by the same models saved as version 2 of a folder and loaded."""
    made, parts = _deployment(spark, sf_dir, reload=False)
    root = shared_folder(spark, "deployment")
    made.save(spark, root, 2)
    test = stored(add_features(parts.where("split = 'test'"), made.baselines, scope=("split",)), "test-features")
    loaded = Deployment.load(spark, root, 2)
    keep = ("p_ml", "s_anom", "hybrid_score", "risk_level")
    both = made.scored(test).select("trans_num", F.struct(*keep).alias("a")).join(loaded.scored(test).select("trans_num", F.struct(*keep).alias("b")), "trans_num")
    return both.select(
        "trans_num", F.abs(F.col("a.p_ml") - F.col("b.p_ml")).alias("probability_difference"), F.abs(F.col("a.s_anom") - F.col("b.s_anom")).alias("anomaly_difference"),
        F.abs(F.col("a.hybrid_score") - F.col("b.hybrid_score")).alias("score_difference"), (F.col("a.risk_level") != F.col("b.risk_level")).alias("tier_changed"))


@query(
    "jb03c_model_scores",
    f"WITH {S.SPLIT}, train AS (SELECT * FROM parts WHERE split = 'train'){S.features('parts', 'train', 'split')}{S.SEVERITIES} "
    "SELECT trans_num, behavioral_score, signal_count, signal_names AS signals, true AS fused FROM sig WHERE split = 'test'",
)
def model_scores(spark, sf_dir):
    """The test split by fitted models: behaviour as values, the score from its three sources."""
    made, parts = _deployment(spark, sf_dir, reload=False)
    test = add_features(parts.where("split = 'test'"), made.baselines, scope=("split",))
    out, cfg = made.scored(test), made.fusion
    mixed = F.round(cfg.w_ml * F.col("p_ml") * 100.0 + cfg.w_anomaly * F.col("s_anom") + cfg.w_rules * F.col("behavioral_score"), 6)
    return out.select(
        "trans_num", "behavioral_score", "signal_count", F.array_join("signals.signal", "; ").alias("signals"),
        (F.abs(mixed - F.col("hybrid_score")) <= 0.5 + 1e-6).alias("fused"))


_CASES = ", ".join(f"('{n}', '{t}', {', '.join(f'{float(v)!r}::DOUBLE' for v in vs)})" for n, t, vs in scenarios.SCENARIOS)


@query(
    "jb07_scenarios",
    f"""WITH {S.TXN}, sc(scenario, expected_tier, {', '.join(scenarios.FIELDS)}) AS (VALUES {_CASES}),
    feat AS (SELECT trans_num, amt, category, is_fraud, sc.* FROM txn CROSS JOIN sc){S.SEVERITIES}{S.surrogates('sig', 'comp')},
    hs AS (SELECT *, {S.fused('0.5::DOUBLE', '0.25::DOUBLE', '0.25::DOUBLE')} AS hybrid_score FROM comp)
    SELECT scenario, expected_tier, {S.tier()} AS risk_level, count(*) AS total, {S.r('avg(behavioral_score)', 4)} AS mean_behaviour FROM hs GROUP BY ALL""",
)
def scenario_tiers(spark, sf_dir):
    """Tier counts per scenario over all amounts and categories of the table."""
    df = scenarios.with_scenarios(txn(spark, sf_dir).select("trans_num", "amt", "category", "is_fraud"))
    out = jobs.score_table(with_surrogates(df), details=False)
    return out.groupBy("scenario", "expected_tier", "risk_level").agg(
        F.count(F.lit(1)).alias("total"), half_even(F.avg("behavioral_score"), 4).alias("mean_behaviour")
    )
