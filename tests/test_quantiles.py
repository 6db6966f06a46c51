from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators.quantiles import medians, quantiles

PROBS = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "p99": 0.99, "hi": 1.0}


@pytest.mark.parametrize("name", ["normal", "copies", "heavy_tail", "constant", "tiny", "negative"])
def test_distributed_plan_is_exact(spark, name):
    rng = np.random.default_rng(3)
    data = {
        "normal": rng.normal(size=501), "copies": np.r_[np.full(400, 7.0), rng.random(100)], "heavy_tail": 1 / rng.random(400) ** 4,
        "constant": np.full(9, 3.0), "tiny": np.array([5.0, 1.0]), "negative": -np.exp(rng.normal(size=300) * 5),
    }[name]
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,), (float("nan"),)], "v double")
    row = quantiles(df, "v", PROBS).first()
    assert [row[n] for n in PROBS] == pytest.approx([np.quantile(data, p) for p in PROBS.values()], rel=1e-12)


def test_groups_agree_with_the_built_in(txns):
    by = ("category", "is_fraud")
    built_in = txns.groupBy(*by).agg(*[F.percentile("amt", p).alias(n) for n, p in PROBS.items()])
    short = {tuple(r[:2]): r[2:] for r in built_in.collect()}
    spread = {tuple(r[:2]): r[2:] for r in quantiles(txns, "amt", PROBS, by=by).collect()}
    assert short.keys() == spread.keys()
    for k in short:
        assert short[k] == pytest.approx(spread[k])


def test_empty_input(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles(df, "v", {"m": 0.5}).select(F.col("m").isNull()).first()[0]


def test_null_groups_nan_and_infinite_values(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", float("nan")), ("a", 2.0), ("a", float("inf")), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in quantiles(df, "v", {"m": 0.0}, by=("g",)).collect()}
    assert got == {None: 1.0, "a": 2.0}
    assert quantiles(df, "v", {"m": 1.0}).first().m == float("inf")


def test_medians_skip_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("nan"),), (float("nan"),)], "v double")
    assert medians(df, ["v"]).first().v == 2.0


def test_value_is_computed_once_a_use(spark):
    """A costly value is not computed again in the filter, the grouping and the slice."""
    value = F.atan2(F.sqrt(F.col("id")), F.lit(2.0)) + F.sin("id")
    plan = quantiles(spark.range(9).withColumn("v", value), "v", {"mid": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ATAN2") == 2  # once for the histogram, once for the picked slices


def test_calibrated_score_parses_a_row_once(spark):
    from riskspark.catalog.functions import calibrated

    plan = calibrated(spark, "/root/testdata/sf0.001").select("score")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") <= 3  # the rows, and twice in the bounds
