"""Evaluation and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.registry import query
from riskspark.catalog.views import components, probabilities, scored, with_surrogates, features
from riskspark.config import BENCHMARK_WEIGHTS, SCORE_SWEEP, SWEEP_9, SWEEP_17, SWEEP_37, WITHOUT_OPERATIONS, simplex_weights
from riskspark.functions.numeric import half_even
from riskspark.operators import fusion, metrics
from riskspark.operators.cost import cheapest, cost_breakdown, policy_comparison, sweep
from riskspark.operators.curves import curve_areas
from riskspark.operators.rules import apply_signals
from riskspark.session import stored

_SIZES = f"tp + fp + fn + tn AS sample_size, tp + fn AS fraud_count, fp + tn AS legitimate_count, {S.r(S.div('tp + fn', 'tp + fp + fn + tn') + ' * 100', 2)} AS fraud_rate_percent"


@query(
    "ev01_comprehensive_metrics",
    f"WITH {S.PROBS}{S.confusion('probs', 'p_ml >= 0.3::DOUBLE')}{S.curve('probs', 'p_ml')}{S.area('curve')} SELECT 'surrogate' AS model_name, {_SIZES}, "
    f"{S.PRECISION} AS precision, {S.RECALL} AS recall, {S.F1} AS f1_score, {S.F2} AS f2_score, pr_auc, roc_auc, {S.FPR} AS false_positive_rate, tp, fp, fn, tn FROM cm CROSS JOIN area",
)
def comprehensive(spark, sf_dir):
    return metrics.comprehensive_metrics(probabilities(spark, sf_dir), F.col("p_ml") >= 0.3, F.col("p_ml"), "surrogate")


@query(
    "ev02_roc_auc",
    # Mann-Whitney with average ranks, independent of the curve.
    f"""WITH {S.PROBS}, k AS (SELECT is_fraud, rank() OVER (ORDER BY p_ml) + (count(*) OVER (PARTITION BY p_ml) - 1) / 2 AS rk FROM probs),
    a AS (SELECT sum(rk) FILTER (is_fraud = 1) AS s, count(*) FILTER (is_fraud = 1)::DOUBLE AS p, count(*) FILTER (is_fraud = 0)::DOUBLE AS n FROM k)
    SELECT {S.r('(s - p * (p + 1) / 2) / (p * n)', 4)} AS roc_auc FROM a""",
)
def roc_auc(spark, sf_dir):
    return curve_areas(probabilities(spark, sf_dir), F.col("p_ml")).select("roc_auc")


@query("ev03_pr_auc", f"WITH {S.PROBS}{S.curve('probs', 'p_ml')}{S.area('curve')} SELECT pr_auc FROM area")
def pr_auc(spark, sf_dir):
    return curve_areas(probabilities(spark, sf_dir), F.col("p_ml")).select("pr_auc")


@query(
    "ev04_metrics_at_threshold",
    f"WITH {S.PROBS}{S.confusion('probs', 'p_ml >= 0.5::DOUBLE')} SELECT 0.5::DOUBLE AS threshold, tp, fp, fn, tn, {S.RATES5}, {S.costs()} FROM cm",
)
def at_threshold(spark, sf_dir):
    return metrics.metrics_at(probabilities(spark, sf_dir), "p_ml", 0.5)


@query(
    "ev05_error_rates",
    f"WITH {S.PROBS}{S.confusion('probs', 'p_ml >= 0.3::DOUBLE')} SELECT tp, fp, fn, tn, {S.r(S.div('tp + tn', 'tp + fp + fn + tn'), 4)} AS accuracy, "
    f"{S.r(S.div('tn', 'tn + fp'), 4)} AS specificity, {S.FPR} AS false_positive_rate, {S.r(S.div('fn', 'fn + tp'), 4)} AS false_negative_rate FROM cm",
)
def error_rates(spark, sf_dir):
    return metrics.error_rates(probabilities(spark, sf_dir), F.col("p_ml") >= 0.3)


def _sweep_sql(name: str, thresholds) -> str:
    values = ", ".join(f"({t!r}::DOUBLE)" for t in thresholds)
    return (
        f"WITH {S.PROBS}, th(threshold) AS (VALUES {values}), x AS (SELECT * FROM probs, th){S.confusion('x', 'p_ml >= threshold', by='threshold')} "
        f"SELECT {S.r('threshold', 6)} AS threshold, tp, fp, fn, tn, {S.RATES5}, {S.costs()} FROM cm"
    )


def _register_sweep(name, thresholds):
    @query(name, _sweep_sql(name, thresholds))
    def probability_sweep(spark, sf_dir):
        out = sweep(probabilities(spark, sf_dir), "p_ml", thresholds, WITHOUT_OPERATIONS)
        return out.withColumn("threshold", half_even(F.col("threshold"), 6))


for _name, _steps in (("ev06_sweep_9", SWEEP_9), ("ev06b_sweep_17", SWEEP_17), ("ev06c_sweep_37", SWEEP_37)):
    _register_sweep(_name, _steps)

_SCORE_GRID = ", ".join(f"({t})" for t in SCORE_SWEEP)


@query(
    "ev07_score_sweep",
    f"WITH {S.SCORED}, th(threshold) AS (VALUES {_SCORE_GRID}), x AS (SELECT * FROM scored, th){S.confusion('x', 'hybrid_score >= threshold', by='threshold')} "
    f"SELECT CAST(threshold AS INTEGER) AS threshold, tp, fp, fn, tn, {S.RATES5}, {S.costs()} FROM cm",
)
def score_sweep(spark, sf_dir):
    return sweep(scored(spark, sf_dir), "hybrid_score", SCORE_SWEEP, WITHOUT_OPERATIONS)


_WEIGHT_ROWS = ", ".join(f"('{n}', {a!r}::DOUBLE, {b!r}::DOUBLE, {c!r}::DOUBLE)" for n, a, b, c in BENCHMARK_WEIGHTS)
_BENCH = (
    f"WITH {S.COMPONENTS}, g(config, wa, wb, wc) AS (VALUES {_WEIGHT_ROWS}), m0 AS (SELECT config, is_fraud, amt, {S.fused('wa', 'wb', 'wc')} AS hybrid_score FROM comp CROSS JOIN g), "
    "m AS (SELECT *, hybrid_score / 100.0::DOUBLE AS s FROM m0)"
    + S.curve("m", "s", "config", "cv") + S.area("cv", "config", digits=5) + S.confusion("m", "hybrid_score >= 50", by="config")
    + f", bench AS (SELECT config, pr_auc, precision, recall, f1, total_cost FROM (SELECT config, {S.RATES}, {S.costs()} FROM cm) JOIN area USING (config))"
)


def _benchmark(spark, sf_dir):
    df = with_surrogates(apply_signals(features(spark, sf_dir), details=False)).select("is_fraud", "amt", "p_ml", "s_anom", "behavioral_score")
    out = fusion.with_weight_sets(stored(df, "components"), BENCHMARK_WEIGHTS)
    weights = (F.col("w_ml"), F.col("w_anomaly"), F.col("w_rules"))
    score = fusion.fuse(F.col("p_ml"), F.col("s_anom"), F.col("behavioral_score"), weights)
    return metrics.benchmark_configs(out.withColumn("hybrid_score", score))


@query("ev08_weight_benchmark", f"{_BENCH} SELECT * FROM bench")
def weight_benchmark(spark, sf_dir):
    return _benchmark(spark, sf_dir)


@query(
    "ev08b_weight_selection",
    f"""{_BENCH}, best AS (SELECT * FROM bench WHERE total_cost = (SELECT min(total_cost) FROM bench))
    SELECT coalesce(arg_max(config, place) FILTER (pr_auc >= 0.999), arg_min(config, place)) AS config, min(total_cost) AS total_cost
    FROM (SELECT *, list_position({[c[0] for c in BENCHMARK_WEIGHTS]!r}, config) AS place FROM best)""",
)
def weight_selection(spark, sf_dir):
    return metrics.select_config(_benchmark(spark, sf_dir), order=[c[0] for c in BENCHMARK_WEIGHTS])


_GRID_ROWS = ", ".join(f"({i}, {a!r}::DOUBLE, {b!r}::DOUBLE, {c!r}::DOUBLE)" for i, a, b, c in simplex_weights())
_GRID_SCORE = "wa * p_ml + wb * (s_anom / 100.0::DOUBLE) + wc * (behavioral_score / 100.0::DOUBLE)"


@query(
    "ev09_weight_grid",
    f"WITH {S.COMPONENTS}, g(config, wa, wb, wc) AS (VALUES {_GRID_ROWS}), m AS (SELECT config, is_fraud, {_GRID_SCORE} AS s FROM comp CROSS JOIN g)"
    + S.curve("m", "s", "config", "cv") + S.area("cv", "config", digits=6) + " SELECT CAST(config AS INTEGER) AS config, pr_auc FROM area",
)
def weight_grid(spark, sf_dir):
    """PR-AUC of every weight set on the simplex grid, in one job partitioned by weight set."""
    df = with_surrogates(apply_signals(features(spark, sf_dir), details=False)).select("is_fraud", "p_ml", "s_anom", "behavioral_score")
    mixed = F.col("w_ml") * F.col("p_ml") + F.col("w_anomaly") * (F.col("s_anom") / 100.0) + F.col("w_rules") * (F.col("behavioral_score") / 100.0)
    return fusion.grid_areas(df, simplex_weights(), mixed, ("p_ml", "s_anom", "behavioral_score")).select("config", "pr_auc")


_MIX = "CAST(least(greatest(round_even(0.75::DOUBLE * (p_ml * 100) + 0.25::DOUBLE * s_anom, 0), 0), 100) AS INTEGER)"


@query(
    "ev10_ablation",
    f"""WITH {S.SCORED}, v AS (
      SELECT 'A supervised' AS model, is_fraud, amt, p_ml AS s, p_ml * 100 >= 40 AS flag FROM scored UNION ALL
      SELECT 'B with anomaly', is_fraud, amt, {_MIX} / 100.0::DOUBLE, {_MIX} >= 40 FROM scored UNION ALL
      SELECT 'C full', is_fraud, amt, hybrid_score / 100.0::DOUBLE, hybrid_score >= 25 FROM scored)"""
    + S.confusion("v", "flag", by="model") + S.curve("v", "s", "model", "cv") + S.area("cv", "model")
    + f" SELECT model, precision, recall, f1, pr_auc, fp, fn, total_cost FROM (SELECT model, fp, fn, {S.RATES}, {S.costs()} FROM cm) JOIN area USING (model)",
)
def ablation(spark, sf_dir):
    df = scored(spark, sf_dir)
    mix = fusion.to_score(F.col("p_ml") * 100.0 * 0.75 + F.col("s_anom") * 0.25)
    return metrics.ablation(
        df,
        {
            "A supervised": (F.col("p_ml"), F.col("p_ml") * 100.0 >= 40),
            "B with anomaly": (mix / 100.0, mix >= 40),
            "C full": (F.col("hybrid_score") / 100.0, F.col("hybrid_score") >= 25),
        },
    )


_GAPS = f"""p AS (SELECT split, tp, fp, fn, {S.div('2 * tp', '2 * tp + fp + fn')} AS f1 FROM cm),
w AS (SELECT max(pr_auc) FILTER (split = 'train') AS a, max(pr_auc) FILTER (split = 'val') AS b, max(f1) FILTER (split = 'train') AS c, max(f1) FILTER (split = 'val') AS d FROM p JOIN area USING (split))
SELECT {S.r('a', 4)} AS train_pr_auc, {S.r('b', 4)} AS val_pr_auc, {S.r('c', 4)} AS train_f1, {S.r('d', 4)} AS val_f1, {S.r('abs(a - b)', 4)} AS gap_pr_auc,
  {S.r('abs(c - d)', 4)} AS gap_f1, abs(a - b) < 0.05 AND abs(c - d) < 0.05 AS generalizes FROM w"""


@query(
    "ev11_overfit_gap",
    f"WITH {S.SPLIT_PROBS}, tv AS (SELECT * FROM probs WHERE split <> 'test'){S.curve('tv', 'p_ml', 'split')}{S.area('curve', 'split', digits=12)}"
    f"{S.confusion('tv', 'p_ml >= 0.3::DOUBLE', by='split')}, {_GAPS}",
)
def overfit(spark, sf_dir):
    return metrics.overfit_gap(probabilities(spark, sf_dir, split=True), "p_ml", 0.3)


@query(
    "ev12_anomaly_diagnostics",
    f"WITH {S.PROBS}{S.confusion('probs', 's_anom >= 65')} SELECT tp + fp + fn + tn AS total_rows, tp + fp AS anomalies, {S.r(S.pct('tp + fp', 'tp + fp + fn + tn'), 2)} AS anomaly_pct, "
    f"tp AS fraud_flagged, fn AS fraud_missed, fp AS legit_flagged, {S.r(S.pct('tp', 'tp + fn'), 2)} AS recall_pct, {S.r(S.pct('tp', 'tp + fp'), 2)} AS precision_pct FROM cm",
)
def diagnostics(spark, sf_dir):
    return metrics.anomaly_diagnostics(probabilities(spark, sf_dir), F.col("s_anom") >= 65.0)


@query("cf01_cost_breakdown", f"WITH {S.SCORED}{S.confusion('scored', 'hybrid_score >= 25')} SELECT tp, fp, fn, tn, {S.RATES}, {S.costs('5')} FROM cm")
def breakdown(spark, sf_dir):
    return cost_breakdown(scored(spark, sf_dir), F.col("hybrid_score") >= 25)


@query("cf02_cost_without_operations", f"WITH {S.PROBS}{S.confusion('probs', 'p_ml >= 0.4::DOUBLE')} SELECT tp, fp, fn, tn, {S.RATES}, {S.costs()} FROM cm")
def without_operations(spark, sf_dir):
    return cost_breakdown(probabilities(spark, sf_dir), F.col("p_ml") >= 0.4, WITHOUT_OPERATIONS)


_TH99 = ", th AS (SELECT CAST(range AS INTEGER) AS threshold FROM range(1, 100)), x AS (SELECT * FROM scored, th)" + S.confusion("x", "hybrid_score >= threshold", by="threshold")


@query("cf03_cost_sweep", f"WITH {S.SCORED}{_TH99} SELECT threshold, tp, fp, fn, tn, {S.RATES}, {S.costs('5')} FROM cm")
def cost_sweep(spark, sf_dir):
    return sweep(scored(spark, sf_dir), "hybrid_score").drop("f2", "fpr")


@query(
    "cf04_optimal_threshold",
    f"WITH {S.SCORED}{_TH99}, c AS (SELECT threshold, tp, fp, fn, tn, {S.RATES}, {S.costs('5')} FROM cm) SELECT * FROM c ORDER BY total_cost, threshold LIMIT 1",
)
def optimal(spark, sf_dir):
    return cheapest(sweep(scored(spark, sf_dir), "hybrid_score").drop("f2", "fpr"))


_UNMITIGATED = "(tp_amt + fn_amt + (tp + fn) * 20)"
_FP, _FN = "(fp_amt * 0.2::DOUBLE + fp * 10)", "(fn_amt + fn * 20)"


@query(
    "cf05_policy_comparison",
    f"WITH {S.SCORED}{S.confusion('scored', 'hybrid_score >= 25')} SELECT {S.r(_UNMITIGATED, 2)} AS unmitigated_cost, {S.r(_FP, 2)} AS fp_cost, {S.r(_FN, 2)} AS fn_cost, "
    f"{S.r(f'{_FN} + {_FP}', 2)} AS total_cost, {S.r(f'{_UNMITIGATED} - ({_FN} + {_FP})', 2)} AS net_savings, "
    f"{S.r(f'({_UNMITIGATED} - ({_FN} + {_FP})) / {_UNMITIGATED} * 100', 2)} AS preservation_pct FROM cm",
)
def policies(spark, sf_dir):
    return policy_comparison(scored(spark, sf_dir), F.col("hybrid_score") >= 25, WITHOUT_OPERATIONS)
