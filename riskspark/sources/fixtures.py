"""Transaction views over the provided tables; every row of the table is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Which transaction category an event type stands for.
EVENT_CATEGORY = {
    "click": "shopping_net",
    "view": "grocery_pos",
    "purchase": "misc_net",
    "signup": "travel",
    "error": "shopping_pos",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str, parse_once: bool = False) -> DataFrame:
    """Card transactions derived from the event stream. With ``parse_once`` a generator keeps the
    parsed property a column, where the optimizer would otherwise parse it once per use; without,
    queries that need none of the derived columns do not read it at all."""
    parsed = F.get_json_object("props", "$.k").cast("bigint")
    k = F.col("k") if parse_once else parsed
    user = F.col("user_id")
    category = F.create_map(*[F.lit(x) for pair in EVENT_CATEGORY.items() for x in pair])
    lat = F.lit(-60.0) + ((user * 7919) % 12000).cast("double") / 100.0
    lon = F.lit(-180.0) + ((user * 104729) % 36000).cast("double") / 100.0
    born = F.make_date(
        (F.lit(1940) + (user * 31) % 70).cast("int"), (F.lit(1) + user % 12).cast("int"), (F.lit(1) + user % 28).cast("int")
    )
    events = table(spark, sf_dir, "events")
    if parse_once:
        events = events.select("*", F.explode(F.array(parsed)).alias("k"))
    return events.select(
        F.col("event_id").cast("string").alias("trans_num"),
        F.col("ts").cast("timestamp").alias("trans_ts"),
        user.alias("cc_num"),
        F.element_at(category, F.col("event_type")).alias("category"),
        (F.col("value") * 10.0).alias("amt"),
        lat.alias("lat"),
        lon.alias("long"),
        (lat + F.when(k < 5, F.lit(20.0)).otherwise((k % 10 - 5).cast("double") / 100.0)).alias("merch_lat"),
        (lon + (k % 7 - 3).cast("double") / 100.0).alias("merch_long"),
        F.when(user % 97 != 0, born).alias("dob"),
        (((k < 5) & (F.col("value") > 60.0)) | (F.col("value") > 250.0)).cast("int").alias("is_fraud"),
    )


def txn_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows on 15 cards, so that velocity bursts occur."""
    return txn(spark, sf_dir).withColumn("cc_num", F.col("cc_num") % 15)


def txn_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with duplicates, bad amounts, bad and missing coordinates, missing categories."""
    e = F.col("trans_num").cast("bigint")
    copies = F.when(e % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        txn(spark, sf_dir)
        .withColumns(
            {
                "amt": F.when(e % 103 != 0, F.when(e % 107 == 0, F.lit(0.0)).otherwise(F.col("amt"))),
                "lat": F.when(e % 109 != 0, F.col("lat")),
                "merch_lat": F.when(e % 113 == 0, F.lit(95.0)).otherwise(F.col("merch_lat")),
                "category": F.when(e % 127 != 0, F.col("category")),
                "event_id": e,
            }
        )
        .withColumn("copy_no", F.explode(copies))
    )


def order_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second source: orders by customer, with day-level times."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("trans_num"),
        F.col("o_orderdate").cast("timestamp").alias("trans_ts"),
        F.col("o_custkey").alias("cc_num"),
        F.col("o_totalprice").alias("amt"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cc_num"), F.col("c_mktsegment").alias("category")
    )
    return orders.join(customers, "cc_num")
