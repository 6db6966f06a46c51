"""Isolation forest as Spark jobs.

Every tree sees at most 256 rows, so fitting draws one bounded pool of rows by
hash order, deals it to the trees, and grows each tree in its own group. The
model is a node table. Scoring is a vectorized function over the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.config import ANOMALY_FEATURES, SPLIT_SEED
from riskspark.functions.numeric import half_even, percent
from riskspark.operators.fusion import calibrate_anomaly
from riskspark.operators.quantiles import quantiles
from riskspark.operators.split import hash_order
from riskspark.session import stored

TREES, SAMPLE = 120, 256
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, rows int, path double"
EULER = 0.5772156649015329


def mean_path(n: float) -> float:
    """Expected path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def deal_rows(df: DataFrame, features: Sequence[str], trees: int, sample: int, seed: int, key: str) -> DataFrame:
    """At most ``trees * sample`` rows with the tree each belongs to. A table too small for
    disjoint samples is dealt round and round, ``sample`` consecutive rows per tree."""
    pool = df.select(F.col(key).alias("_key"), *[F.col(f).cast("double").alias(f) for f in features])
    pool = pool.orderBy(hash_order("_key", seed), "_key").limit(trees * sample)
    everything = W.partitionBy()  # the pool is bounded by the model's size
    placed = pool.withColumns(
        {
            "_at": F.row_number().over(everything.orderBy(hash_order("_key", seed), "_key")) - 1,
            "_rows": F.count(F.lit(1)).over(everything),
        }
    )
    each = F.least(F.lit(sample), F.col("_rows"))
    mine = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(F.col("_at") - t * each, F.col("_rows")) < each)
    return placed.select(F.explode(mine).alias("tree"), F.col("_at").alias("at"), *features)


def _grow(rows: pd.DataFrame, features: list[str], seed: int) -> pd.DataFrame:
    """One tree over its sample: random feature, random cut, until rows or height run out."""
    tree = int(rows["tree"].iloc[0])
    x = rows.sort_values("at")[features].to_numpy(float)
    rng = np.random.default_rng([seed, tree])
    height = math.ceil(math.log2(max(len(x), 2)))
    nodes, open_nodes = [], [(np.arange(len(x)), 0)]
    children = {}
    while open_nodes:
        members, depth = open_nodes.pop(0)
        me = len(nodes)
        part = x[members]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(members) > 1 and depth < height else []
        if len(spread) == 0:
            nodes.append((tree, me, -1, 0.0, me, me, len(members), depth + mean_path(len(members))))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        goes_left = part[:, f] <= cut
        children[me] = me + len(open_nodes) + 1  # children are numbered in queue order
        nodes.append((tree, me, f, cut, children[me], children[me] + 1, len(members), float(depth)))
        open_nodes += [(members[goes_left], depth + 1), (members[~goes_left], depth + 1)]
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "rows", "path"])


def calibration_bounds(df: DataFrame, raw: str = "raw") -> DataFrame:
    """0.5 and 99.5 percentile of the raw score; a degenerate range is widened by one."""
    q = quantiles(df, raw, {"low": 0.005, "high": 0.995})
    return q.select("low", F.when(F.col("high") <= F.col("low"), F.col("low") + 1.0).otherwise(F.col("high")).alias("high"))


@dataclass
class IsolationForest:
    """A fitted forest: its node table, the features in order, rows per tree, and the calibration."""

    nodes: pd.DataFrame
    features: tuple[str, ...]
    sample: int
    low: float = -0.5
    high: float = 0.5

    @classmethod
    def fit(
        cls, df: DataFrame, features: Sequence[str] = ANOMALY_FEATURES, trees: int = TREES, sample: int = SAMPLE,
        seed: int = SPLIT_SEED, key: str = "trans_num",
    ) -> "IsolationForest":
        """Grow the trees, then calibrate on the raw scores of the whole fitting frame."""
        names = list(features)
        dealt = deal_rows(df, names, trees, sample, seed, key)
        grown = dealt.groupBy("tree").applyInPandas(lambda rows: _grow(rows, names, seed), NODE_SCHEMA)
        nodes = grown.toPandas().sort_values(["tree", "node"])  # bounded: trees times 2 * sample nodes
        forest = cls(nodes, tuple(names), int(nodes.groupby("tree")["rows"].max().max()))
        raw = stored(df.select(forest.raw_score().alias("raw")), "raw-scores")  # the quantiles read it more than once
        bounds = calibration_bounds(raw).first()
        forest.low, forest.high = bounds["low"], bounds["high"]
        return forest

    def raw_score(self) -> Column:
        """-2 ** (-mean path / expected path): the lower, the more isolated."""
        arrays = [
            (np.maximum(t["feature"].to_numpy(np.int64), 0), t["threshold"].to_numpy(), t[["right", "left"]].to_numpy(np.int64).ravel(), t["path"].to_numpy())
            for _, t in self.nodes.groupby("tree")
        ]  # both children of a leaf are the leaf, so whichever feature it is given does not matter
        expected, height = mean_path(self.sample), math.ceil(math.log2(max(self.sample, 2)))
        shared = SparkSession.active().sparkContext.broadcast(arrays)

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            cells, first, total = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x))
            for feature, threshold, children, path in shared.value:
                node = np.zeros(len(x), dtype=np.int64)
                for _ in range(height):
                    met = cells.take(first + feature.take(node)) <= threshold.take(node)
                    node = children.take(2 * node + met)
                total += path.take(node)
            return pd.Series(-np.exp2(-total / len(shared.value) / expected))

        return score(*[F.col(f).cast("double") for f in self.features])

    def score_100(self) -> Column:
        return calibrate_anomaly(self.raw_score(), F.lit(self.low), F.lit(self.high))

    def with_scores(self, df: DataFrame, name: str = "s_anom") -> DataFrame:
        return df.withColumn(name, self.score_100())

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(list(self.features), self.sample, float(self.low), float(self.high))]
        spark.createDataFrame(meta, "features array<string>, sample int, low double, high double").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsolationForest":
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
        meta = spark.read.schema("features array<string>, sample int, low double, high double").json(f"{path}/meta").first()
        return cls(nodes, tuple(meta["features"]), meta["sample"], meta["low"], meta["high"])


def contamination_trials(train: DataFrame, held: DataFrame, shares: Sequence[float] = (0.02, 0.03, 0.04), raw: str = "raw") -> DataFrame:
    """Held-out rows below the raw-score quantile of each assumed contamination, in one pass."""
    names = {f"q{i}": share for i, share in enumerate(shares)}
    cuts = quantiles(train, raw, names).select(F.struct("*")).scalar()
    rows = held.withColumn("_cuts", cuts).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(raw) < F.col(f"_cuts.{n}")).alias(n) for n in names]
    )
    pairs = F.array(*[F.struct(F.lit(s).alias("contamination"), F.col(n).alias("flagged")) for n, s in names.items()])
    return rows.select("_n", F.inline(pairs)).select(
        "contamination", "flagged", half_even(percent(F.col("flagged"), F.col("_n")), 2).alias("flagged_pct")
    )
