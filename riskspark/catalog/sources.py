"""IO: readers, writers, contracts, config table, decision log."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.registry import query
from riskspark.catalog.views import probabilities, scored, split_txn, txn, txn_dirty, with_surrogates, features
from riskspark.functions.numeric import half_even
from riskspark.functions.text import mask_card
from riskspark.operators.clean import cleaning_log
from riskspark.operators.cost import sweep
from riskspark.operators.features import Baselines
from riskspark.operators.fusion import action, apply_config_table, apply_fusion, normalized
from riskspark.operators.metrics import comprehensive_metrics
from riskspark.operators.rules import apply_signals
from riskspark.operators.split import split_summary
from riskspark.config import FROZEN_FUSION
from riskspark.session import shared_folder
from riskspark.sources import store, transactions

RAW_ROWS = "trans_num, epoch_us(trans_ts) AS ts_us, cc_num, category, amt, is_fraud"


@query("io01_load_csv", f"WITH {S.TXN} SELECT {RAW_ROWS} FROM txn")
def load_csv(spark, sf_dir):
    """The transactions as CSV, read back through the declared schema."""
    path = shared_folder(spark, "raw-csv")
    names = [f.split()[0] for f in transactions.RAW_SCHEMA.replace("\n", " ").split(",")]
    df = txn(spark, sf_dir).withColumn("trans_date_trans_time", F.date_format("trans_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    rows = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in names])
    rows.write.option("header", True).csv(path)
    return transactions.read_csv(spark, path).select(
        "trans_num", F.unix_micros("trans_ts").alias("ts_us"), "cc_num", "category", "amt", "is_fraud"
    )


_QUALITY = ("cc_num", "category", "amt", "lat", "long", "merch_lat", "merch_long", "is_fraud")


@query(
    "io02_column_contract",
    f"WITH {S.DIRTY} SELECT 'trans_date_trans_time' AS column_name, false AS present, count(*) AS null_count FROM dirty UNION ALL SELECT 'merchant', false, count(*) FROM dirty UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', true, count(*) FILTER ({c} IS NULL) FROM dirty" for c in _QUALITY),
)
def column_contract(spark, sf_dir):
    return transactions.column_quality(txn_dirty(spark, sf_dir).drop("trans_ts"))


@query("io03_write_splits", f"WITH {S.SPLIT} SELECT split, count(*) AS total_rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_count FROM parts GROUP BY split")
def write_splits(spark, sf_dir):
    path = shared_folder(spark, "splits")
    store.write_splits(split_txn(spark, sf_dir), path)
    return store.read_split(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("total_rows"), F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_count")
    )


@query("io04_load_splits", f"WITH {S.SPLIT} SELECT trans_num, amt, is_fraud FROM parts WHERE split = 'val'")
def load_splits(spark, sf_dir):
    """Built on the first call, read by partition pruning afterwards."""
    path = shared_folder(spark, "splits")
    store.load_or_build_splits(spark, path, lambda: split_txn(spark, sf_dir))
    again = store.load_or_build_splits(spark, path, lambda: split_txn(spark, sf_dir))
    return again.where(F.col("split") == "val").select("trans_num", "amt", "is_fraud")


@query(
    "io05_export_processed",
    f"WITH {S.SPLIT} SELECT split, count(*) AS total_rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, "
    f"{S.r('sum(is_fraud)::DOUBLE / count(*) * 100', 2)} AS fraud_percent, (SELECT count(*) FROM valid) AS clean_rows FROM parts GROUP BY split",
)
def export_processed(spark, sf_dir):
    """Split table plus a JSON summary: cleaning log, split sizes."""
    path = shared_folder(spark, "processed")
    store.write_splits(split_txn(spark, sf_dir), f"{path}/table")
    parts = split_summary(store.read_split(spark, f"{path}/table"))
    log = cleaning_log(txn(spark, sf_dir)).select(F.struct("*")).scalar()
    summary = parts.withColumn("cleaning", log)
    store.write_metrics(summary, f"{path}/summary")
    return store.read_metrics(spark, f"{path}/summary", summary.schema).select(
        "split", "total_rows", "fraud_count", "fraud_percent", F.col("cleaning.final_row_count").alias("clean_rows")
    )


_SWEPT = "threshold, tp, fp, fn, tn, precision, recall, f1, fn_cost, fp_cost, total_cost"


@query(
    "io06_sweep_table",
    f"WITH {S.SCORED}, th AS (SELECT CAST(range AS INTEGER) AS threshold FROM range(1, 100)), x AS (SELECT * FROM scored, th)"
    + S.confusion("x", "hybrid_score >= threshold", by="threshold")
    + f" SELECT {_SWEPT} FROM (SELECT threshold, tp, fp, fn, tn, {S.RATES}, {S.costs('5')} FROM cm)",
)
def sweep_table(spark, sf_dir):
    path = shared_folder(spark, "sweep")
    swept = sweep(scored(spark, sf_dir), "hybrid_score").select(*_SWEPT.split(", "))
    store.write_sweep(swept, path)
    return store.read_sweep(spark, path, swept.schema)


_SIZES = f"tp + fp + fn + tn AS sample_size, tp + fn AS fraud_count, fp + tn AS legitimate_count, {S.r(S.div('tp + fn', 'tp + fp + fn + tn') + ' * 100', 2)} AS fraud_rate_percent"


@query(
    "io07_metrics_json",
    f"WITH {S.PROBS}{S.confusion('probs', 'p_ml >= 0.5::DOUBLE')}{S.curve('probs', 'p_ml')}{S.area('curve')} SELECT 'surrogate' AS model_name, {_SIZES}, "
    f"{S.PRECISION} AS precision, {S.RECALL} AS recall, {S.F1} AS f1_score, {S.F2} AS f2_score, pr_auc, roc_auc, {S.FPR} AS false_positive_rate, tp, fp, fn, tn FROM cm CROSS JOIN area",
)
def metrics_json(spark, sf_dir):
    path = shared_folder(spark, "metrics")
    df = probabilities(spark, sf_dir)
    metrics = comprehensive_metrics(df, F.col("p_ml") >= 0.5, F.col("p_ml"), "surrogate")
    store.write_metrics(metrics, path)
    return store.read_metrics(spark, path, metrics.schema)


@query(
    "io08_saved_baselines",
    f"WITH {S.TXN}{S.baselines()} SELECT trans_num, {S.r('card_mean', 8)} AS card_mean, {S.r('category_median', 4)} AS category_median "
    "FROM txn JOIN cards USING (cc_num) JOIN cats USING (category)",
)
def saved_baselines(spark, sf_dir):
    """Baselines fitted, saved, loaded and applied from the files."""
    path = shared_folder(spark, "baselines")
    df = txn(spark, sf_dir)
    Baselines.fit(df).save(path)
    loaded = Baselines.load(spark, path)
    joined = loaded.with_categories(loaded.with_cards(df))
    return joined.select("trans_num", half_even(F.col("card_mean"), 8).alias("card_mean"), half_even(F.col("category_median"), 4).alias("category_median"))


# Config documents keyed by deployment; one per transaction category, built from the table itself.
_CONFIG_SQL = f"""WITH {S.COMPONENTS},
n AS (SELECT category, count(*) AS rows, row_number() OVER (ORDER BY category) AS i FROM txn GROUP BY category),
cfg AS (SELECT category AS config_id,
  CASE i WHEN 1 THEN 0.5 WHEN 2 THEN 0.7 ELSE 0.65 END::DOUBLE AS a, CASE i WHEN 1 THEN 0.25 ELSE 0.2 END::DOUBLE AS b,
  CASE i WHEN 1 THEN 0.25 ELSE 0.15 END::DOUBLE AS c, CASE i WHEN 3 THEN 30 ELSE 35 END::DOUBLE AS low_max, 69::DOUBLE AS medium_max FROM n),
x AS (SELECT *, {S.fused('(a / (a + b + c))', '(b / (a + b + c))', '(c / (a + b + c))')} AS hybrid_score FROM comp CROSS JOIN cfg)
SELECT config_id, {S.tier(low='low_max', medium='medium_max')} AS risk_level, count(*) AS total FROM x GROUP BY ALL"""


@query("io09_config_table", _CONFIG_SQL)
def config_table(spark, sf_dir):
    """Documents in the nested, the flat and the empty form, parsed with fall-backs, all scored in one job."""
    from pyspark.sql import Window as W

    docs = {
        1: '{"component_weights": {"ml_weight": 0.5, "anomaly_weight": 0.25, "behavioral_weight": 0.25}}',
        2: '{"ml_weight": 0.7}',
        3: '{"low_risk_threshold": 30}',
    }
    doc = F.when(F.col("i") == 1, docs[1]).when(F.col("i") == 2, docs[2]).when(F.col("i") == 3, docs[3]).otherwise("{}")
    named = txn(spark, sf_dir).groupBy(F.col("category").alias("config_id")).count()
    named = named.withColumn("i", F.row_number().over(W.partitionBy().orderBy("config_id"))).withColumn("doc", doc)
    comp = with_surrogates(apply_signals(features(spark, sf_dir), details=False)).select("p_ml", "s_anom", "behavioral_score")
    out = apply_config_table(comp, store.parse_configs(named))
    return out.groupBy("config_id", "risk_level").agg(F.count(F.lit(1)).alias("total"))


@query(
    "io10_decision_log",
    f"WITH {S.SCORED} SELECT trans_num, '**** **** **** ' || right(cc_num::VARCHAR, 4) AS card_masked, amt, category, hybrid_score, "
    "p_ml AS fraud_prob, risk_level FROM scored WHERE risk_level = 'MEDIUM RISK' AND contains(lower(category), 'shop')",
)
def decision_log(spark, sf_dir):
    """Two appends to the log, then a search by tier and category text."""
    path = shared_folder(spark, "decisions")
    df = apply_fusion(with_surrogates(apply_signals(features(spark, sf_dir), details=False)), FROZEN_FUSION)
    log = df.select(
        "trans_num", mask_card(F.col("cc_num")).alias("card_masked"), "amt", "category", "hybrid_score", "risk_level",
        F.col("p_ml").alias("fraud_prob"), F.col("recommended_action").alias("action"), F.col("trans_ts").alias("logged_at"),
    )
    night = F.hour("logged_at") < 6
    store.append_decisions(log.where(night), path)
    store.append_decisions(log.where(~night), path)
    found = store.search_decisions(spark.read.parquet(path), "MEDIUM RISK", "SHOP")
    return found.select("trans_num", "card_masked", "amt", "category", "hybrid_score", "fraud_prob", "risk_level")
