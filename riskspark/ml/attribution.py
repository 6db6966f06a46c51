"""Shapley attribution of the fitted models, row by row, in log-odds (forests: probability).

Linear models have a closed form. For trees, a leaf's value is shared out among the features on the way to
it. With share_j the part of the training rows that pass feature j's conditions and met_j whether the row meets
them, feature i gets

    value * (met_i - share_i) * integral over t in [0, 1] of the product over j != i of (share_j * (1 - t) + met_j * t).

The integrand is a polynomial of degree d - 1 for d features, so Gauss-Legendre with (d + 1) // 2 points is exact, and
a leaf is d numbers of each kind, whatever its depth. The model's arrays are bounded by its nodes times its features; they
are broadcast after their bytes are counted.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.ml.supervised import FraudModel
from riskspark.operators.explain import linear_contributions
from riskspark.session import shared_folder


MODEL_BYTES = 256 << 20  # what may be sent to every executor
CELLS = 1 << 20          # rows times leaves times features worked on at once
TABLE_BYTES = 64 << 20   # of the answers kept by the conditions met


@dataclass
class Leaves:
    """All leaves with the same number of features on their way: a row of each array per leaf."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    amount: np.ndarray

    @property
    def bytes(self) -> int:
        return sum(a.nbytes for a in (self.features, self.low, self.high, self.share, self.amount))

    def add_to(self, phi: np.ndarray, x: np.ndarray) -> None:
        n, d = self.features.shape
        some = max(1, CELLS // (d * max(len(x), 1)))
        for a in range(0, n, some):
            f, share, amount = self.features[a : a + some], self.share[a : a + some], self.amount[a : a + some]
            values = x[:, f]
            met = ((values > self.low[a : a + some]) & (values <= self.high[a : a + some])).astype(float)
            given = _given(share, met, amount)
            for i in range(d):
                to = np.zeros((len(f), phi.shape[1]))
                to[np.arange(len(f)), f[:, i]] = 1.0
                phi += given[:, :, i] @ to


class Tables:
    """Of a leaf, what a row gets depends only on which of its conditions the row meets: every answer is worked out
    once, and a row looks them up. 2 ** d answers for d features; leaves come in order of d while they fit into
    ``limit`` bytes, those that do not keep their quadrature. A condition that many leaves share is tested once."""

    def __init__(self, leaves: list[Leaves], width: int, limit: int = TABLE_BYTES):
        self.rest: list[Leaves] = []
        self.answers: list[tuple[np.ndarray, np.ndarray]] = []
        places: dict[tuple, int] = {}
        for group in leaves:
            n, d = group.features.shape
            each = (width << d) * 8
            fit = min(n, limit // each)
            limit -= fit * each
            if fit < n:
                self.rest.append(Leaves(*(a[fit:] for a in (group.features, group.low, group.high, group.share, group.amount))))
            for leaf in range(fit):
                f = group.features[leaf]
                met = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
                table = np.zeros((1 << d, width))
                table[:, f] = _given(group.share[leaf], met, group.amount[leaf : leaf + 1])
                conditions = zip(f.tolist(), group.low[leaf].tolist(), group.high[leaf].tolist())
                self.answers.append((np.array([places.setdefault(c, len(places)) for c in conditions]), table))
        self.conditions = list(places)

    def add_to(self, phi: np.ndarray, x: np.ndarray) -> None:
        met = np.empty((len(self.conditions), len(x)), dtype=np.int64)
        columns = np.ascontiguousarray(x.T)
        for place, (f, low, high) in enumerate(self.conditions):
            met[place] = (columns[f] > low) & (columns[f] <= high)
        for places, table in self.answers:
            pattern = met[places[-1]]
            for place in places[-2::-1]:
                pattern = (pattern << 1) | met[place]
            phi += table.take(pattern, axis=0)
        for group in self.rest:
            group.add_to(phi, x)


def _given(share: np.ndarray, met: np.ndarray, amount: np.ndarray) -> np.ndarray:
    """What each feature gets of a leaf's value; features along the last axis."""
    points, weights = np.polynomial.legendre.leggauss((share.shape[-1] + 1) // 2)
    inner = np.zeros(np.broadcast_shapes(share.shape, met.shape))
    for t, w in zip((points + 1) / 2, weights / 2):
        factors = share * (1 - t) + met * t
        inner += w * factors.prod(axis=-1, keepdims=True) / factors
    return inner * (met - share) * amount[:, None]


def explain(model: FraudModel, df: DataFrame, name: str = "contributions") -> DataFrame:
    """Adds (feature, value, contribution) per feature and ``base_value``; base plus contributions
    is the model's output for the row."""
    if isinstance(model.classifier, LogisticRegressionModel):
        return _explain_linear(model, df, name)
    leaves, base = tree_leaves(df.sparkSession, model)
    size = sum(group.bytes for group in leaves)
    if size > MODEL_BYTES:
        raise ValueError(f"the model's {size} bytes of leaves are over the {MODEL_BYTES} that are sent to every executor")
    shared = df.sparkSession.sparkContext.broadcast(leaves)
    width = len(model.features)

    @F.pandas_udf("array<double>")
    def contributions(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        tables = Tables(shared.value, width)
        for columns in batches:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            yield pd.Series(list(_batch(x, [tables], width)))

    values = [F.col(f).cast("double") for f in model.features]
    items = [
        F.struct(F.lit(f).alias("feature"), v.alias("value"), F.col("_phi")[i].alias("contribution"))
        for i, (f, v) in enumerate(zip(model.features, values))
    ]
    return df.withColumn("_phi", contributions(*values)).withColumns({name: F.array(*items), "base_value": F.lit(base)}).drop("_phi")


def _explain_linear(model: FraudModel, df: DataFrame, name: str) -> DataFrame:
    scaler, logistic = model.pipeline.stages[1], model.classifier
    std = np.where(scaler.std.toArray() == 0, 1.0, scaler.std.toArray())
    weights = dict(zip(model.features, logistic.coefficients.toArray() / std))
    means = dict(zip(model.features, scaler.mean.toArray()))
    return linear_contributions(df, weights, means, float(logistic.intercept), name)


def _batch(x: np.ndarray, leaves: Sequence[Leaves | Tables], width: int) -> np.ndarray:
    phi = np.zeros((len(x), width))
    for a in range(0, len(x), 1024):
        for group in leaves:
            group.add_to(phi[a : a + 1024], x[a : a + 1024])
    return phi


def tree_leaves(spark: SparkSession, model: FraudModel) -> tuple[list[Leaves], float]:
    """Leaves of every tree, read from the saved model (its size is set by its parameters)."""
    path = shared_folder(spark, "trees")
    model.classifier.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()
    if isinstance(model.classifier, GBTClassificationModel):
        scale = 2.0 * np.asarray(model.classifier.treeWeights)  # the log-odds is twice the ensemble's sum
        value = lambda n: n.prediction
    elif isinstance(model.classifier, RandomForestClassificationModel):
        scale = np.full(nodes["treeID"].nunique(), 1.0 / nodes["treeID"].nunique())
        value = lambda n: n.impurityStats[1] / sum(n.impurityStats)
    else:
        raise TypeError(f"no tree attribution for {type(model.classifier).__name__}")
    boosted = isinstance(model.classifier, GBTClassificationModel)
    cover = (lambda n: n.impurityStats[0]) if boosted else (lambda n: sum(n.impurityStats))
    found, base = [], 0.0
    for tree, part in nodes.groupby("treeID"):
        rows = {n.id: n for n in part.itertuples()}
        for leaf, conditions in _walk(rows, cover):
            amount = value(leaf) * scale[tree]
            base += amount * float(np.prod([z for _, _, z in conditions.values()]))
            if conditions and amount:
                found.append((amount, conditions))
    return grouped(found), float(base)


def grouped(found: list[tuple[float, dict]]) -> list[Leaves]:
    """From (value, feature -> (low, high, share)) of every leaf."""
    by_size: dict[int, list] = defaultdict(list)
    for amount, conditions in found:
        by_size[len(conditions)].append((amount, list(conditions), *zip(*conditions.values())))
    out = []
    for _, rows in sorted(by_size.items()):
        amount, features, low, high, share = zip(*rows)
        out.append(Leaves(np.array(features), np.array(low, float), np.array(high, float), np.array(share, float), np.array(amount, float)))
    return out


def _walk(rows: dict, cover) -> Iterator[tuple]:
    """Every leaf with its conditions: feature -> (low, high, share of rows passing)."""
    stack = [(rows[0], {})]
    while stack:
        node, conditions = stack.pop()
        if node.leftChild < 0:
            yield node, conditions
            continue
        f, cut = node.split["featureIndex"], node.split["leftCategoriesOrThreshold"][0]
        low, high, share = conditions.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((node.leftChild, (low, min(high, cut))), (node.rightChild, (max(low, cut), high))):
            passing = share * cover(rows[child]) / cover(node)
            stack.append((rows[child], {**conditions, f: (*bounds, passing)}))
