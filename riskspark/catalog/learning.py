"""Learning jobs. Trained models have no SQL counterpart; these queries return invariant-checked summaries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.functions import CALIBRATED, calibrated
from riskspark.catalog.registry import query
from riskspark.catalog.views import probabilities, split_txn, stored_split
from riskspark.config import ANOMALY_FEATURES, FEATURES
from riskspark.functions.numeric import half_even
from riskspark.ml import attribution, iforest, supervised
from riskspark.operators import explain
from riskspark.operators.features import Baselines, add_features
from riskspark.operators.metrics import comprehensive_metrics
from riskspark.session import stored

# Held-out rows and the features of every split, in SQL; trained models are checked by what must hold of them.
_PARTS = S.SPLIT + ", train AS (SELECT * FROM parts WHERE split = 'train')" + S.features("parts", "train", "split")
_HELD = "(SELECT * FROM parts WHERE split = 'val')"
TOLERANCE = 1e-6


def _featured(spark, sf_dir):
    """Split rows with features of baselines fitted on the training split; written, as every model reads them."""
    parts = stored_split(spark, sf_dir)
    base = Baselines.fit(parts.where("split = 'train'"))
    df = stored(add_features(parts, base, scope=("split",)).select("trans_num", "is_fraud", "split", "category", *FEATURES), "model-features")
    return df.where("split = 'train'"), df.where("split = 'val'")


@query(
    "ml01_class_weights",
    f"""WITH {S.SPLIT}, t AS (SELECT is_fraud, count(*) AS rows, sum(count(*)) OVER () AS n FROM parts WHERE split = 'train' GROUP BY is_fraud)
    SELECT is_fraud, rows, {S.r('n / (2 * rows)', 6)} AS balanced_weight, CASE WHEN is_fraud = 1 THEN 61.61::DOUBLE ELSE 1::DOUBLE END AS positive_weight FROM t""",
)
def class_weights(spark, sf_dir):
    train = split_txn(spark, sf_dir).where("split = 'train'")
    both = supervised.positive_weights(supervised.balanced_weights(train).withColumnRenamed(supervised.WEIGHT, "b"))
    return both.groupBy("is_fraud").agg(
        F.count(F.lit(1)).alias("rows"), half_even(F.max("b"), 6).alias("balanced_weight"), F.max(supervised.WEIGHT).alias("positive_weight")
    )


_SCALED = "avg((v - m) / d)", "stddev_samp((v - m) / d)"


@query(
    "ml02_standardization",
    f"WITH {_PARTS}, fit AS (SELECT * FROM feat WHERE split = 'train') "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {S.r(_SCALED[0], 4)} + 0 AS mean, {S.r(_SCALED[1], 4)} + 0 AS deviation FROM "
        f"(SELECT {f}::DOUBLE AS v, avg({f}) OVER () AS m, stddev_samp({f}) OVER () AS d FROM fit)" for f in FEATURES
    ),
)
def standardization(spark, sf_dir):
    """Mean 0 and deviation 1 per feature after scaling (population over sample deviation differs in the 4th digit)."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import vector_to_array

    train, _ = _featured(spark, sf_dir)
    x = supervised._assembler(FEATURES).transform(train)
    scaled = StandardScaler(inputCol="_x", outputCol="_s", withMean=True).fit(x).transform(x).select(vector_to_array("_s").alias("s"))
    long = scaled.select(F.posexplode("s").alias("i", "v"))
    names = F.array(*[F.lit(f) for f in FEATURES])
    return long.groupBy(F.element_at(names, F.col("i") + 1).alias("feature")).agg(
        (half_even(F.avg("v"), 4) + 0.0).alias("mean"), (half_even(F.stddev_samp("v"), 4) + 0.0).alias("deviation")
    )


def _metrics(model, held):
    """Sizes, whether the confusion adds up to them, and whether the areas beat a score that knows nothing
    (PR-AUC the share of frauds, ROC-AUC one half)."""
    out = comprehensive_metrics(model.with_probability(held), F.col("p_ml") >= 0.5, F.col("p_ml"), model.name)
    return out.select(
        "model_name", "sample_size", "fraud_count", "legitimate_count",
        ((F.col("tp") + F.col("fn") == F.col("fraud_count")) & (F.col("fp") + F.col("tn") == F.col("legitimate_count"))).alias("adds_up"),
        ((F.col("pr_auc") > F.col("fraud_count") / F.col("sample_size")) & (F.col("roc_auc") > 0.5)).alias("better_than_chance"),
    )


def _metrics_sql(name: str) -> str:
    return (
        f"WITH {S.SPLIT} SELECT '{name}' AS model_name, count(*) AS sample_size, count(*) FILTER (is_fraud = 1) AS fraud_count, "
        f"count(*) FILTER (is_fraud = 0) AS legitimate_count, true AS adds_up, true AS better_than_chance FROM {_HELD}"
    )


@query("ml03_logistic_regression", _metrics_sql("LogisticRegression"))
def logistic(spark, sf_dir):
    train, val = _featured(spark, sf_dir)
    return _metrics(supervised.fit_logistic(train), val)


@query("ml04_random_forest", _metrics_sql("RandomForest"))
def forest(spark, sf_dir):
    train, val = _featured(spark, sf_dir)
    return _metrics(supervised.fit_forest(train), val)


@query("ml05_histogram_boosting", _metrics_sql("HistGradientBoosting"))
def histogram_boosting(spark, sf_dir):
    train, val = _featured(spark, sf_dir)
    return _metrics(supervised.fit_histogram_boosting(train), val)


@query("ml06_boosted_trees", _metrics_sql("BoostedTrees"))
def boosted(spark, sf_dir):
    train, val = _featured(spark, sf_dir)
    return _metrics(supervised.fit_boosted(train, {}), val)


@query("ml07_model_selection", "SELECT * FROM (VALUES ('RandomForest', 0, true), ('HistGradientBoosting', 1, true)) m(model, place, consistent)")
def selection(spark, sf_dir):
    train, val = _featured(spark, sf_dir)
    models = [supervised.fit_forest(train), supervised.fit_histogram_boosting(train)]
    best, scores = supervised.select_model(models, val)
    rows = [r.asDict() for r in scores.collect()]  # one row per candidate
    first = min((-r["pr_auc"], r["place"]) for r in rows)[1]
    chosen = F.lit(best.name)
    return scores.select("model", "place", ((F.col("place") == first) == (F.col("model") == chosen)).alias("consistent"))


_GRID = ", ".join(f"({i}, {p['max_depth']}, {p['learning_rate']!r}::DOUBLE, {p['scale_pos_weight']!r}::DOUBLE)" for i, p in enumerate(supervised.SEARCH_GRID, 1))


@query("ml08_hyperparameter_search", f"SELECT *, true AS in_range FROM (VALUES {_GRID}) g(trial, max_depth, learning_rate, scale_pos_weight)")
def hyperparameters(spark, sf_dir):
    train, val = _featured(spark, sf_dir)
    best, history = supervised.search(train, val)
    ranges = [F.col(c).between(0.0, 1.0) for c in ("val_pr_auc", "val_roc_auc", "val_f1")]
    return history.select("trial", "max_depth", "learning_rate", "scale_pos_weight", (ranges[0] & ranges[1] & ranges[2] & (F.col("total_cost") >= 0)).alias("in_range"))


@query("ml09_importance", "SELECT unnest([" + ", ".join(f"'{f}'" for f in FEATURES) + "]) AS feature, true AS shared_out")
def importance(spark, sf_dir):
    """Gain importance next to permutation importance."""
    train, val = _featured(spark, sf_dir)
    model = supervised.fit_forest(train)
    lost = supervised.permutation_importance(model, val).withColumnRenamed("importance", "pr_auc_loss")
    both = supervised.gain_importance(model, val).join(lost, "feature")
    whole = both.agg(F.sum("share_pct")).scalar()
    return both.select("feature", ((F.abs(whole - 100.0) < 0.1) & F.col("pr_auc_loss").between(-1.0, 1.0)).alias("shared_out"))


def _forest(spark, sf_dir, trees=120):
    train, val = _featured(spark, sf_dir)
    return iforest.IsolationForest.fit(train, trees=trees), train, val


@query(
    "ml10_iforest_fit",
    f"WITH {S.SPLIT}, n AS (SELECT count(*) AS n FROM parts WHERE split = 'train') SELECT CAST(t.range AS INTEGER) AS tree, CAST(least(256, n) AS BIGINT) AS sample_rows, "
    "true AS binary_tree, true AS within_depth FROM n, range(120) t",
)
def iforest_fit(spark, sf_dir):
    """Per tree: its sample, whether every inner node has two children, and whether paths stay in bounds."""
    forest, _, _ = _forest(spark, sf_dir)
    nodes = spark.createDataFrame(forest.nodes, iforest.NODE_SCHEMA)
    return nodes.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("rows"))).cast("bigint").alias("sample_rows"),
        (F.count(F.lit(1)) == 2 * F.count_if(F.col("feature") < 0) - 1).alias("binary_tree"),
        (F.max("path") < 256).alias("within_depth"),
    )


@query("ml11_iforest_scores", f"WITH {S.SPLIT} SELECT trans_num, is_fraud, true AS in_range FROM {_HELD}")
def iforest_scores(spark, sf_dir):
    forest, _, val = _forest(spark, sf_dir)
    return forest.with_scores(val).select("trans_num", "is_fraud", F.col("s_anom").between(0.0, 100.0).alias("in_range"))


@query(
    "ml12_calibration_bounds",
    f"WITH {S.TXN}{S.distance('txn')}, {CALIBRATED} SELECT {S.r('lo', 6)} AS low, {S.r('hi', 6)} AS high FROM q2",
)
def bounds(spark, sf_dir):
    out = iforest.calibration_bounds(calibrated(spark, sf_dir).select("raw"))
    return out.select(half_even(F.col("low"), 6).alias("low"), half_even(F.col("high"), 6).alias("high"))


_TRIAL = (
    "SELECT {c}::DOUBLE AS contamination, count(*) FILTER (p_ml < (SELECT quantile_cont(p_ml, {c}) FROM probs WHERE split = 'train')) AS flagged, "
    + S.r(S.pct("count(*) FILTER (p_ml < (SELECT quantile_cont(p_ml, {c}) FROM probs WHERE split = 'train'))", "count(*)"), 2) + " AS flagged_pct FROM probs WHERE split = 'val'"
)


@query("ev13b_contamination_cuts", f"WITH {S.SPLIT_PROBS} " + " UNION ALL ".join(_TRIAL.format(c=c) for c in (0.02, 0.03, 0.04)))
def contamination_cuts(spark, sf_dir):
    """The trials on a score both engines can compute."""
    rows = probabilities(spark, sf_dir, split=True)
    raw = F.col("p_ml").alias("raw")
    return iforest.contamination_trials(rows.where("split = 'train'").select(raw), rows.where("split = 'val'").select(raw))


@query("ev13_contamination_trials", "SELECT unnest([0.02::DOUBLE, 0.03, 0.04]) AS contamination, true AS growing")
def contamination(spark, sf_dir):
    forest, train, val = _forest(spark, sf_dir, trees=100)
    raw = forest.raw_score().alias("raw")
    out = iforest.contamination_trials(train.select(raw), val.select(raw))
    below = F.coalesce(F.lag("flagged").over(W.partitionBy().orderBy("contamination")), F.lit(0))  # three rows
    return out.select("contamination", ((F.col("flagged") >= below) & F.col("flagged_pct").between(0.0, 100.0)).alias("growing"))


_LINEAR = ", ".join(f"avg({f}) OVER () AS m_{f}" for f in FEATURES)


@query(
    "ml13_linear_attribution",
    f"WITH {S.TXN}{S.features()}, x AS (SELECT *, {_LINEAR} FROM feat) "
    + " UNION ALL ".join(f"SELECT trans_num, '{f}' AS feature, {S.r(f'0.5::DOUBLE * ({f} - m_{f})', 4)} AS contribution FROM x" for f in FEATURES),
)
def linear_attribution(spark, sf_dir):
    """The closed form, with the feature means taken from the data."""
    from riskspark.catalog.views import features

    df = features(spark, sf_dir)
    means = df.agg(F.struct(*[F.avg(f).alias(f) for f in FEATURES])).scalar()
    out = explain.linear_contributions(
        df.withColumn("_m", means), {f: 0.5 for f in FEATURES}, {f: F.col(f"_m.{f}") for f in FEATURES}
    )
    rows = out.select("trans_num", F.inline("contributions"))
    return rows.select("trans_num", "feature", half_even(F.col("contribution"), 4).alias("contribution"))


def _explained(spark, sf_dir):
    train, val = _featured(spark, sf_dir)
    model = supervised.fit_boosted(train, {})
    return attribution.explain(model, model.with_probability(val))


@query("ml13b_tree_attribution", f"WITH {S.SPLIT} SELECT trans_num, true AS additive FROM {_HELD}")
def tree_attribution(spark, sf_dir):
    """Per row: base plus contributions are the model's log-odds."""
    out = _explained(spark, sf_dir)
    total = F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c["contribution"])
    log_odds = F.log(F.col("p_ml") / (1.0 - F.col("p_ml")))
    return out.select("trans_num", (F.abs(total - log_odds) < TOLERANCE * (1.0 + F.abs(log_odds))).alias("additive"))


@query("ml14_global_attribution", "SELECT unnest([" + ", ".join(f"'{f}'" for f in FEATURES) + "]) AS feature, true AS averaged")
def global_attribution(spark, sf_dir):
    """The mean sizes against a second way to them: summed and counted by row."""
    rows = stored(_explained(spark, sf_dir).select("contributions"), "contributions")
    out = explain.global_attribution(rows)
    by_row = rows.select(F.inline("contributions")).groupBy("feature").agg((F.sum(F.abs("contribution")) / rows.count()).alias("again"))
    return out.join(by_row, "feature").select("feature", (F.abs(F.col("mean_abs_contribution") - F.col("again")) < TOLERANCE).alias("averaged"))


@query("ml15_dependence", f"WITH {_PARTS} SELECT trans_num, {S.r('amt_to_user_avg_ratio', 6)} AS feature_value, true AS known FROM feat WHERE split = 'val'")
def dependence(spark, sf_dir):
    out = explain.dependence(_explained(spark, sf_dir))
    return out.select("trans_num", half_even(F.col("feature_value"), 6).alias("feature_value"), F.col("contribution").isNotNull().alias("known"))


@query("ml16_bar_drivers", f"WITH {S.SPLIT} SELECT trans_num, CAST(t.range AS INTEGER) AS place, true AS in_order FROM {_HELD}, range(8) t")
def drivers(spark, sf_dir):
    """Per row and place: the driver there is the one of that size among all contributions."""
    sizes = F.reverse(F.array_sort(F.transform("contributions", lambda c: F.abs(c["contribution"]))))
    out = explain.bar_factors(_explained(spark, sf_dir), 8).withColumn("sizes", sizes)
    out = out.select("trans_num", "sizes", F.posexplode("drivers").alias("place", "d"))
    return out.select("trans_num", "place", (F.abs("d.contribution") == F.col("sizes")[F.col("place")]).alias("in_order"))
