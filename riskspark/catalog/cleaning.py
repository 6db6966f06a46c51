"""Cleaning, request checks, split and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import sql as S
from riskspark.catalog.registry import query
from riskspark.catalog.views import features, split_txn, txn, txn_dirty
from riskspark.functions.numeric import half_even
from riskspark.functions.text import mask_card
from riskspark.operators import clean as C
from riskspark.operators.split import seeded_sample, split_summary, stratified_split

ORDER = ("event_id", "copy_no")


@query("cl01_dedup_keep_first", f"WITH {S.DIRTY} SELECT trans_num, copy_no, amt, category FROM firsts")
def dedup(spark, sf_dir):
    return C.keep_first(txn_dirty(spark, sf_dir), order=ORDER).select("trans_num", "copy_no", "amt", "category")


@query("cl02_positive_amounts", f"WITH {S.DIRTY} SELECT trans_num, copy_no, amt FROM dirty WHERE amt > 0")
def positive(spark, sf_dir):
    return C.drop_bad_amounts(txn_dirty(spark, sf_dir)).select("trans_num", "copy_no", "amt")


@query(
    "cl03_valid_coordinates",
    f"WITH {S.DIRTY} SELECT trans_num, copy_no, {S.r('lat', 6)} AS lat, {S.r('merch_lat', 6)} AS merch_lat FROM dirty "
    "WHERE NOT coalesce(abs(lat) > 90, false) AND NOT coalesce(abs(long) > 180, false) "
    "AND NOT coalesce(abs(merch_lat) > 90, false) AND NOT coalesce(abs(merch_long) > 180, false)",
)
def coordinates(spark, sf_dir):
    kept = C.drop_bad_coordinates(txn_dirty(spark, sf_dir))
    return kept.select("trans_num", "copy_no", half_even(F.col("lat"), 6).alias("lat"), half_even(F.col("merch_lat"), 6).alias("merch_lat"))


_IMPUTED = ("lat", "long", "merch_lat", "merch_long")


@query(
    "cl04_impute_medians",
    f"WITH {S.DIRTY}, m AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in _IMPUTED)} FROM located) SELECT trans_num, "
    + ", ".join(f"{S.r(f'coalesce({c}, m_{c})', 6)} AS {c}" for c in _IMPUTED)
    + " FROM located CROSS JOIN m",
)
def impute(spark, sf_dir):
    kept = C.drop_bad_coordinates(C.drop_bad_amounts(C.keep_first(txn_dirty(spark, sf_dir), order=ORDER)))
    return C.impute_medians(kept).select("trans_num", *[half_even(F.col(c), 6).alias(c) for c in _IMPUTED])


@query("cl05_impute_unknown", f"WITH {S.DIRTY} SELECT trans_num, copy_no, coalesce(category, 'UNKNOWN') AS category FROM dirty")
def unknown(spark, sf_dir):
    return C.impute_unknown(txn_dirty(spark, sf_dir)).select("trans_num", "copy_no", "category")


@query(
    "cl06_label_domain",
    f"""WITH {S.TXN}, planted AS (SELECT CASE WHEN amt > 300 THEN 2 WHEN amt < 20 THEN NULL ELSE is_fraud END AS is_fraud FROM txn)
    SELECT count(*) AS rows, count(*) FILTER (is_fraud NOT IN (0, 1) OR is_fraud IS NULL) AS violations FROM planted""",
)
def label_domain(spark, sf_dir):
    """Raw labels with wrong and missing ones planted by amount."""
    planted = F.when(F.col("amt") > 300, F.lit(2)).when(F.col("amt") < 20, F.lit(None)).otherwise(F.col("is_fraud"))
    return C.label_domain_violations(txn(spark, sf_dir).withColumn("is_fraud", planted))


@query(
    "cl07_cleaning_log",
    f"""WITH {S.DIRTY}, a AS (SELECT count(*) AS n FROM dirty), b AS (SELECT count(*) AS n FROM firsts),
    c AS (SELECT count(*) AS n FROM paid), d AS (SELECT count(*) AS n FROM located)
    SELECT a.n - b.n AS duplicates_removed, b.n - c.n AS invalid_amounts_removed, c.n - d.n AS invalid_coords_removed,
      a.n AS initial_row_count, d.n AS final_row_count, a.n - d.n AS total_records_dropped FROM a, b, c, d""",
)
def log(spark, sf_dir):
    return C.cleaning_log(txn_dirty(spark, sf_dir), order=ORDER)


def _requests(spark, sf_dir):
    """Feature rows as requests, with some values pushed out of range."""
    e = F.col("trans_num").cast("bigint")
    return features(spark, sf_dir).withColumns(
        {
            "hour": F.when(e % 7 == 0, F.lit(24)).otherwise(F.col("hour")),
            "customer_age": F.when(e % 11 == 0, F.lit(17.0)).otherwise(F.col("customer_age")),
            "amt": F.when(e % 13 == 0, F.lit(0.0)).otherwise(F.col("amt")),
        }
    )


@query(
    "cl08_request_validation",
    f"""WITH {S.TXN}, v AS (SELECT trans_num, concat_ws(',',
      CASE WHEN trans_num::BIGINT % 13 = 0 OR NOT amt > 0 THEN 'amt' END, CASE WHEN trans_num::BIGINT % 7 = 0 THEN 'hour' END,
      CASE WHEN trans_num::BIGINT % 11 = 0 THEN 'customer_age' END,
      CASE WHEN NOT amt > 0 THEN 'amt_to_user_avg_ratio,amt_to_cat_median_ratio' END) AS violations FROM txn)
    SELECT trans_num, violations, violations = '' AS is_valid FROM v""",
)
def validation(spark, sf_dir):
    return C.validate_requests(_requests(spark, sf_dir)).select(
        "trans_num", F.array_join("violations", ",").alias("violations"), "is_valid"
    )


@query(
    "cl09_night_inference",
    f"WITH {S.TXN} SELECT trans_num, CASE WHEN trans_num::BIGINT % 3 = 0 THEN 1 WHEN hour(trans_ts) <= 5 THEN 1 ELSE 0 END AS is_night_transaction FROM txn",
)
def night(spark, sf_dir):
    given = F.when(F.col("trans_num").cast("bigint") % 3 == 0, F.lit(1))
    df = txn(spark, sf_dir).withColumns({"hour": F.hour("trans_ts"), "is_night_transaction": given})
    return C.infer_night_flag(df).select("trans_num", "is_night_transaction")


@query(
    "cl10_fill_coordinates",
    f"""WITH {S.DIRTY}{S.distance('txn')}, d2 AS (SELECT trans_num AS t, haversine_distance_km AS km FROM dist)
    SELECT trans_num, copy_no, {S.r('coalesce(lat, 32.7767::DOUBLE)', 6)} AS lat,
      {S.r('CASE WHEN event_id % 5 = 0 THEN 32.7767::DOUBLE + km / 111 ELSE merch_lat END', 6)} AS merch_lat
    FROM dirty JOIN d2 ON d2.t = trans_num""",
)
def fill(spark, sf_dir):
    from riskspark.functions.geo import haversine_km

    km = haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    known = txn(spark, sf_dir).select("trans_num", km.alias("haversine_distance_km"))
    df = txn_dirty(spark, sf_dir).withColumn("merch_lat", F.when(F.col("event_id") % 5 != 0, F.col("merch_lat")))
    out = C.fill_coordinates(df.join(known, "trans_num"))
    return out.select("trans_num", "copy_no", half_even(F.col("lat"), 6).alias("lat"), half_even(F.col("merch_lat"), 6).alias("merch_lat"))


@query("cl11_card_masking", f"WITH {S.TXN} SELECT trans_num, '**** **** **** ' || right(cc_num::VARCHAR, 4) AS card_masked FROM txn")
def masking(spark, sf_dir):
    return txn(spark, sf_dir).select("trans_num", mask_card(F.col("cc_num")).alias("card_masked"))


@query("sp01_stratified_split", f"WITH {S.SPLIT} SELECT trans_num, is_fraud, split FROM parts")
def stratified(spark, sf_dir):
    return split_txn(spark, sf_dir).select("trans_num", "is_fraud", "split")


@query("sp01b_split_distributed", f"WITH {S.SPLIT} SELECT trans_num, is_fraud, split FROM parts")
def stratified_distributed(spark, sf_dir):
    """The plan for classes too large for one task: thresholds on the hash, no shuffle of the rows."""
    valid = C.drop_bad_coordinates(C.drop_bad_amounts(txn(spark, sf_dir)))
    return stratified_split(valid).select("trans_num", "is_fraud", "split")


@query(
    "sp02_split_summary",
    f"WITH {S.SPLIT} SELECT split, count(*) AS total_rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, "
    f"count(*) - CAST(sum(is_fraud) AS BIGINT) AS legit_count, {S.r('sum(is_fraud)::DOUBLE / count(*) * 100', 2)} AS fraud_percent FROM parts GROUP BY split",
)
def summary(spark, sf_dir):
    return split_summary(split_txn(spark, sf_dir))


@query(
    "sp03_seeded_sample",
    f"WITH {S.TXN} SELECT trans_num, amt, is_fraud FROM txn ORDER BY md5(concat_ws('|', 's42', trans_num)), trans_num LIMIT 500",
)
def sample(spark, sf_dir):
    return seeded_sample(txn(spark, sf_dir), 500).select("trans_num", "amt", "is_fraud")
