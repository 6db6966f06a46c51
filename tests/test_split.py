from __future__ import annotations

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.config import SPLIT_SEED
from riskspark.operators.split import class_cuts, hash_order, seeded_sample, split_summary, stratified_split


def test_published_class_counts(spark):
    sizes = spark.createDataFrame([(0, 49202), (1, 798)], "is_fraud int, n long")
    cuts = {r.is_fraud: (r.cut_train, r.cut_val) for r in class_cuts(sizes, "is_fraud").collect()}
    assert cuts == {0: (34441, 34441 + 7380), 1: (559, 559 + 120)}


def test_shares_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        class_cuts(spark.createDataFrame([(0, 1)], "is_fraud int, n long"), "is_fraud", (0.7, 0.2, 0.2))


def test_split_equals_ranking_each_class(txns):
    cuts = class_cuts(txns.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n")), "is_fraud")
    place = F.row_number().over(W.partitionBy("is_fraud").orderBy(hash_order("trans_num", SPLIT_SEED), "trans_num"))
    name = F.when(F.col("place") <= F.col("cut_train"), "train").when(F.col("place") <= F.col("cut_val"), "val").otherwise("test")
    direct = txns.withColumn("place", place).join(cuts, "is_fraud").select("trans_num", name.alias("split"))
    spread = stratified_split(txns).select("trans_num", "split")
    assert direct.count() == txns.count()
    assert direct.exceptAll(spread).count() == 0 and spread.exceptAll(direct).count() == 0


def test_one_class_dominates(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("trans_num"), F.when(F.col("id") < 7, 1).otherwise(0).alias("is_fraud"))
    counts = {r.split: (r.total_rows, r.fraud_count) for r in split_summary(stratified_split(df)).collect()}
    assert counts["train"] == (1400, 5) and sum(c[0] for c in counts.values()) == 2000
    assert sum(c[1] for c in counts.values()) == 7


def test_sample_is_repeatable(txns):
    first = {r.trans_num for r in seeded_sample(txns, 50).collect()}
    assert first == {r.trans_num for r in seeded_sample(txns.repartition(7), 50).collect()} and len(first) == 50
