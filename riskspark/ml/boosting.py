"""Boosted trees with MLlib's loss, splits and model, grown from histograms of binned rows.

Rows are kept as blocks of one byte per feature, the label and the margin so far, dealt evenly to the cores. A pass adds up
the histograms of one level: rows walk the tree, and of two siblings only the smaller is counted, the other is the
parent less that one. Passes are many and short, so they run on the RDD of blocks, without a plan of their own.
"""

from __future__ import annotations

import gc
import heapq
import json
import math
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import shared_folder

BLOCK_ROWS = 1 << 16  # columns of a block stay in a core's cache
TASK_ROWS = (1 << 16, 1 << 23)  # a pass has no more tasks than fill the one, and no fewer than the other allows
LEVEL_NODES = 1024  # nodes whose histograms one pass adds up
COLLECTED = 1 << 24  # bytes of histograms that the driver adds up itself
LINEAGE = 25  # rounds between checkpoints of the margins
PURE = 1e-12  # share of a node's squares below which a gain is rounding


@dataclass
class Tree:
    """Nodes by number, children side by side and after their parent; a leaf is its own child, whatever the bin."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    depth: int = 0

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The node every column of ``bins`` ends in."""
        rows = bins.shape[1]
        at, place, flat = np.zeros(rows, np.intp), np.arange(rows), bins.reshape(-1)
        for _ in range(self.depth):
            where = self.feature.take(at)
            where *= rows
            where += place
            right = flat.take(where) > self.cut.take(at)
            at = self.child.take(at)
            at += right
        return at


@dataclass
class Nodes:
    """What the driver keeps of a tree: ``stats`` has rows, positives, sum and sum of squares of the residuals by node."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    weights: tuple[float, float]

    @classmethod
    def root(cls, weights: tuple[float, float]) -> "Nodes":
        return cls(np.zeros(1, np.intp), np.full(1, -1), np.zeros(1, np.intp), np.full(1, -1.0), np.zeros((4, 1)), weights)

    def weight(self) -> np.ndarray:
        return _weighted(self.stats[0], self.stats[1], self.weights)

    def split(self, parents: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Adds two children to each parent; ``left`` has rows, positives and sum of the left ones. Returns the left children."""
        first = len(self.child) + 2 * np.arange(len(parents))
        self.feature[parents], self.cut[parents], self.child[parents], self.gain[parents] = feature, cut, first, gain
        new = 2 * len(parents)
        stats = np.full((4, new), np.nan)
        stats[:3, ::2], stats[:3, 1::2] = left, self.stats[:3, parents] - left
        self.feature = np.concatenate([self.feature, np.zeros(new, np.intp)])
        self.cut = np.concatenate([self.cut, np.full(new, -1)])
        self.child = np.concatenate([self.child, len(self.child) + np.arange(new)])
        self.gain = np.concatenate([self.gain, np.full(new, -1.0)])
        self.stats = np.concatenate([self.stats, stats], axis=1)
        return first

    def parent(self, children: np.ndarray) -> np.ndarray:
        inner, of = np.flatnonzero(self.cut >= 0), np.zeros(len(self.child), np.intp)
        of[self.child[inner]] = of[self.child[inner] + 1] = inner
        return of[children]

    def tree(self, depth: int) -> Tree:
        weight = self.weight()
        value = np.divide(self.stats[2], weight, out=np.zeros(len(weight)), where=weight > 0)
        cut = np.where(self.cut < 0, 65_535, self.cut).astype(np.uint16)
        return Tree(self.feature, cut, self.child, value, depth)


@cache
def _settle() -> None:
    """Once in a worker: what is loaded stays out of the collection after every task, which takes longer than the task itself."""
    gc.collect()
    gc.freeze()


def _weighted(rows: np.ndarray, positives: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    return weights[0] * (rows - positives) + weights[1] * positives


def thresholds(sample: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's cuts of one feature: between all distinct values if these are few, else next to even shares of the weight."""
    values, inverse = np.unique(sample, return_inverse=True)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) < bins:
        return middle
    counts = np.bincount(inverse, weights=weight)
    stride = counts.sum() / bins
    out, current, target = [], counts[0], stride
    for i in range(1, len(values)):
        before, current = current, current + counts[i]
        if abs(before - target) < abs(current - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out[: bins - 1])


def _blocks(df: DataFrame, cuts: Sequence[np.ndarray], label: str, features: Sequence[str]) -> RDD:
    """Blocks (number, bins by feature, label, margin) of the rows, dealt evenly by their counts."""
    width, kind = len(features), np.uint8 if max(map(len, cuts)) < 256 else np.uint16
    item = np.dtype(kind).itemsize

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def block():
            table = pa.Table.from_batches(held).combine_chunks()
            if any(c.null_count for c in table.columns):
                raise ValueError("labels and features must not be null")
            y, *columns = (c.to_numpy() for c in table.columns)
            if not np.isin(y, (0.0, 1.0)).all() or any(np.isnan(c).any() for c in columns):
                raise ValueError("labels must be 0 or 1, and features not NaN")
            x = np.concatenate([np.searchsorted(cut, c).astype(kind) for cut, c in zip(cuts, columns)])
            return pa.RecordBatch.from_pydict({"block": pa.array([y.astype(np.uint8).tobytes() + x.tobytes()], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                held.append(part)
                rows += part.num_rows
                if rows >= BLOCK_ROWS:
                    yield block()
                    held, rows = [], 0
        if rows:
            yield block()

    wide = df.select(F.col(label).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f) for f in features])
    found = wide.mapInArrow(binned, "block binary").rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    sized = found.mapPartitionsWithIndex(lambda part, blocks: [((part, i), len(b) // (1 + width * item)) for i, b in enumerate(blocks)]).collect()
    rows, few, most = sum(n for _, n in sized), *TASK_ROWS
    tasks = max(min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // few)), -(-rows // most), 1)
    place, heap = {}, [(0, task) for task in range(tasks)]
    for number, (key, n) in sorted(enumerate(sized), key=lambda s: -s[1][1]):
        held, task = heapq.heappop(heap)
        place[key] = (task, number)
        heapq.heappush(heap, (held + n, task))

    def unpacked(block: tuple[int, bytes]) -> tuple:
        number, data = block
        n = len(data) // (1 + width * item)
        return number, np.frombuffer(data, kind, width * n, n).reshape(width, n).copy(), np.frombuffer(data, np.uint8, n), np.zeros(n)

    dealt = found.mapPartitionsWithIndex(lambda part, blocks: ((place[part, i][0], (place[part, i][1], b)) for i, b in enumerate(blocks)))
    out = dealt.partitionBy(tasks, int).values().map(unpacked).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    out.count()
    found.unpersist()
    return out


@dataclass
class Passes:
    """What a pass over the blocks needs to know besides the tree."""

    weights: tuple[float, float]
    width: int
    bins: int
    seed: int
    rate: float

    def residuals(self, y: np.ndarray, margin: np.ndarray, turn: int) -> np.ndarray:
        """Of MLlib's log loss 2 log(1 + exp(-2 y margin)), labels as 1 and -1; the first round fits the labels."""
        sign = 2.0 * y - 1.0
        if turn == 0:
            return sign
        with np.errstate(over="ignore"):
            return 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))

    def kept(self, number: int, rows: int, turn: int) -> np.ndarray | None:
        return None if self.rate >= 1.0 else np.random.default_rng((self.seed, turn, number)).random(rows) < self.rate

    def histograms(self, blocks: Iterable[tuple], tree: Tree, slots: np.ndarray, turn: int) -> Iterator[tuple]:
        """(feature, (rows, positives, sums)) by slot and bin, and (-1, squares by slot), of the nodes that have a slot."""
        _settle()
        wide = (int(slots.max()) + 1) * self.bins
        rows, positives, sums = np.zeros((self.width, wide), np.int64), np.zeros((self.width, wide), np.int64), np.zeros((self.width, wide))
        squares, held, waiting = np.zeros(wide // self.bins), [], 0

        def count():
            base, x, y, g = (np.concatenate(part, axis=-1) for part in zip(*held))
            weighted = g * np.where(y == 1, self.weights[1], self.weights[0])
            squares[:] += np.bincount(base, weights=weighted * g, minlength=len(squares))
            base *= self.bins
            fraud = np.flatnonzero(y)
            for f in range(self.width):
                key = base + x[f]
                rows[f] += np.bincount(key, minlength=wide)
                sums[f] += np.bincount(key, weights=weighted, minlength=wide)
                positives[f] += np.bincount(key[fraud], minlength=wide)

        for number, x, y, margin in blocks:
            slot = slots.take(tree.walk(x))
            wanted, kept = slot >= 0, self.kept(number, len(y), turn)
            chosen = np.flatnonzero(wanted if kept is None else wanted & kept)
            if len(chosen) == len(y):
                held.append((slot, x, y, self.residuals(y, margin, turn)))
            elif len(chosen):
                some = y.take(chosen)
                held.append((slot.take(chosen), x.take(chosen, axis=1), some, self.residuals(some, margin.take(chosen), turn)))
            waiting += len(chosen)
            if waiting >= max(4 * BLOCK_ROWS, 4 * wide):
                count()
                held, waiting = [], 0
        if held:
            count()
        yield from ((f, [rows[f], positives[f], sums[f]]) for f in range(self.width))
        yield -1, [squares]

    def level(self, blocks: RDD, tree: Tree, slots: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows, positives and sums by feature, slot and bin, and squares by slot, over all blocks."""
        nodes = int(slots.max()) + 1
        found = blocks.mapPartitions(lambda part: self.histograms(part, tree, slots, turn))
        if 24 * self.width * nodes * self.bins * blocks.getNumPartitions() > COLLECTED:
            found = found.reduceByKey(_added, min(blocks.getNumPartitions(), self.width + 1))
        sums: dict = {}
        for f, part in found.collect():
            sums[f] = _added(sums[f], part) if f in sums else part
        (squares,) = sums.pop(-1)
        return np.stack([np.stack(sums[f]) for f in range(self.width)], axis=1).reshape(3, self.width, nodes, self.bins), squares


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b)]


def best_splits(sums: np.ndarray, weights: tuple[float, float], allowed: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Per node the feature, cut and gain of least variance, first of equals, with the left side's rows, positives and sum.
    Gain 0: no split. ``allowed`` are the features (by node) that may split."""
    width, nodes, bins = sums.shape[1:]
    feature, cut, gain, left = np.zeros(nodes, np.intp), np.zeros(nodes, np.intp), np.zeros(nodes), np.zeros((3, nodes))
    for a in range(0, nodes if bins > 1 else 0, 64):
        part = slice(a, min(a + 64, nodes))
        run = np.cumsum(sums[:, :, part], axis=-1)
        low, high = run[..., :-1], run[..., -1:] - run[..., :-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = run[..., -1]
            apart = low[2] ** 2 / _weighted(low[0], low[1], weights) + high[2] ** 2 / _weighted(high[0], high[1], weights)
            weight = _weighted(whole[0], whole[1], weights)
            gains = apart - (whole[2] ** 2 / weight)[..., None]
            gains[(low[0] == 0) | (high[0] == 0) | ~(gains > PURE * apart)] = 0.0
        if allowed is not None:
            gains *= allowed[part].T[..., None]
        cuts = gains.argmax(axis=-1)
        each = np.take_along_axis(gains, cuts[..., None], -1)[..., 0]
        best, at = each.argmax(axis=0), np.arange(each.shape[1])
        feature[part], cut[part], gain[part] = best, cuts[best, at], each[best, at] / weight[best, at]
        left[:, part] = low[:, best, at, cuts[best, at]]
    return feature, cut, gain, left


def grow(blocks: RDD, passes: Passes, depth: int, turn: int, drawn: int) -> Nodes:
    """One tree, level by level. ``drawn`` features may split a node."""
    nodes, rng = Nodes.root(passes.weights), np.random.default_rng((passes.seed, turn))
    active, parents = np.zeros(1, np.intp), None  # with the parents' sums, active are the smaller siblings
    for level in range(max(depth, 1)):
        first, kept = [], []
        for counted in [active] if parents is not None else np.array_split(active, -(-len(active) // LEVEL_NODES)):
            slots = np.full(len(nodes.child), -1)
            slots[counted] = np.arange(len(counted))
            sums, nodes.stats[3, counted] = passes.level(blocks, nodes.tree(level), slots, turn)
            if parents is not None:
                rest, parent = parents - sums, nodes.parent(counted)
                rest[2][rest[0] == 0] = 0.0
                sibling = 2 * nodes.child[parent] + 1 - counted
                nodes.stats[3, sibling] = nodes.stats[3, parent] - nodes.stats[3, counted]
                sums, counted = np.concatenate([sums, rest], axis=2), np.concatenate([counted, sibling])
            if level == 0:
                nodes.stats[:3, 0] = sums[:, 0].sum(axis=(1, 2))
            if depth == 0:
                return nodes
            allowed = rng.random((len(counted), passes.width)).argsort(axis=1) < drawn if drawn < passes.width else None
            feature, cut, gain, left = best_splits(sums, passes.weights, allowed)
            splits = np.flatnonzero(gain > 0)
            first.append(nodes.split(counted[splits], feature[splits], cut[splits], gain[splits], left[:, splits]))
            kept.append(sums[:, :, splits] if len(active) <= LEVEL_NODES else None)
        first = np.concatenate(first)
        rows, positives = nodes.stats[:2]
        leaf = rows < 2
        if turn == 0:
            leaf |= (positives == 0) | (positives == rows)  # labels of one class
        open_ = ~(leaf[first] & leaf[first + 1])
        if not open_.any():
            break
        first = first[open_]
        if len(kept) == 1 and kept[0] is not None and len(first) <= LEVEL_NODES:
            active, parents = np.where(rows[first] <= rows[first + 1], first, first + 1), kept[0][:, :, open_]
        else:
            active, parents = np.concatenate([first, first + 1]), None
    return nodes


def _advanced(blocks: RDD, tree: Tree, step: float) -> RDD:
    """The blocks with a tree's share added to the margins."""
    shared = tree.value * step
    return blocks.map(lambda b: (*b[:3], b[3] + shared.take(tree.walk(b[1]))), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK_DESER)


def _drawn(strategy: str, width: int) -> int:
    """MLlib's number of features per node."""
    named = {"auto": width, "all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), width) if strategy.isdigit() else math.ceil(float(strategy) * width)


def fit(estimator: GBTClassifier, df: DataFrame, features: Sequence[str]) -> GBTClassificationModel:
    """The model ``estimator`` describes. Weights belong to the label: all rows of a class have the same."""
    spark, label, seed, step = df.sparkSession, estimator.getLabelCol(), estimator.getSeed(), estimator.getStepSize()
    weight = F.col(estimator.getWeightCol())
    classes = {r.label: r for r in df.groupBy(F.col(label).cast("double").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.min(weight).alias("least"), F.max(weight).alias("most")).limit(3).collect()}
    if not classes or not set(classes) <= {0.0, 1.0} or any(c.least != c.most or c.least is None for c in classes.values()):
        raise ValueError("boosting needs rows, labels 0 or 1, and one weight per label")
    weights = tuple(float(classes[c].least) if c in classes else 1.0 for c in (0.0, 1.0))
    rows, wanted = sum(c.n for c in classes.values()), max(estimator.getMaxBins() ** 2, 10_000)
    some = df if rows <= wanted else df.sample(wanted / rows, seed)
    sample = some.select(F.col(label).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f) for f in features]).toPandas()
    sampled = np.where(sample["_y"] == 1, weights[1], weights[0])
    known = {f: sample[f].notna().to_numpy() for f in features}
    cuts = [thresholds(sample[f].to_numpy()[known[f]], sampled[known[f]], min(estimator.getMaxBins(), rows)) for f in features]

    passes = Passes(weights, len(features), max(map(len, cuts)) + 1, seed, estimator.getSubsamplingRate())
    drawn, depth = _drawn(estimator.getFeatureSubsetStrategy(), len(features)), estimator.getMaxDepth()
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "rounds"))
    blocks, written, grown = _blocks(df, cuts, label, features), [], []
    for turn in range(estimator.getMaxIter()):
        last = blocks
        if turn:
            blocks = _advanced(last, grown[-1].tree(depth), step if turn > 1 else 1.0)
            if turn % LINEAGE == 0:
                blocks.checkpoint()
                written.append(blocks)
        grown.append(grow(blocks, passes, depth, turn, drawn))
        if turn:
            last.unpersist()
    blocks.unpersist()
    for rdd in written:  # nobody's after the last round
        path = spark._jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return _model(spark, estimator, grown, cuts)


def _model(spark: SparkSession, estimator: GBTClassifier, grown: Sequence[Nodes], cuts: Sequence[np.ndarray]) -> GBTClassificationModel:
    """MLlib's model of the trees, loaded from its own file format. The squares of a leaf are known
    if it was a candidate for a split; others carry the least there can be."""
    path = shared_folder(spark, "boosted")
    width = max(map(len, cuts), default=0) + 1
    table = np.zeros((len(cuts), width))
    for f, cut in enumerate(cuts):
        table[f, : len(cut)] = cut
    sizes = [len(n.child) for n in grown]
    whole = lambda pick: np.concatenate([pick(n) for n in grown])
    inner = whole(lambda n: n.cut) >= 0
    weight, total = whole(Nodes.weight), whole(lambda n: n.stats[2])
    value = np.divide(total, weight, out=np.zeros(len(weight)), where=weight > 0)
    least = value * total
    squares = whole(lambda n: n.stats[3])
    squares = np.where(np.isnan(squares), least, np.maximum(squares, least))
    impurity = np.divide(squares - least, weight, out=np.zeros(len(weight)), where=weight > 0)
    feature, child = whole(lambda n: n.feature), whole(lambda n: n.child)
    at = table[feature, np.maximum(whole(lambda n: n.cut), 0)]
    lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.float64()))
    split = pa.StructArray.from_arrays(
        [pa.array(np.where(inner, feature, -1), pa.int32()), lists(np.concatenate([[0], np.cumsum(inner)]), at[inner]), pa.array(np.full(len(inner), -1), pa.int32())],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    stats = lists(3 * np.arange(len(inner) + 1), np.column_stack([weight, total, squares]).ravel())
    fields = {
        "id": pa.array(np.concatenate([np.arange(n) for n in sizes]), pa.int32()), "prediction": pa.array(value), "impurity": pa.array(impurity),
        "impurityStats": stats, "rawCount": pa.array(np.rint(whole(lambda n: n.stats[0])), pa.int64()), "gain": pa.array(whole(lambda n: n.gain)),
        "leftChild": pa.array(np.where(inner, child, -1), pa.int32()), "rightChild": pa.array(np.where(inner, child + 1, -1), pa.int32()), "split": split,
    }
    nodes = pa.table({"treeID": pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()), "nodeData": pa.StructArray.from_arrays(list(fields.values()), list(fields))})
    spark.createDataFrame(nodes).write.parquet(f"{path}/data")

    params = {p.name: v for p, v in estimator._paramMap.items()}
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items()}
    own = {"lossType", "maxIter", "stepSize", "validationTol", "rawPredictionCol", "probabilityCol", "featureSubsetStrategy", "subsamplingRate", "thresholds", "validationIndicatorCol"}
    about = lambda kind, uid, **more: json.dumps(
        {"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, **more})
    parts = {"paramMap": {k: v for k, v in params.items() if k not in own}, "defaultParamMap": {k: v for k, v in defaults.items() if k not in own}}
    trees = [
        (i, about("regression.DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", **parts), 1.0 if i == 0 else float(estimator.getStepSize())) for i in range(len(grown))
    ]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    line = about("classification.GBTClassificationModel", estimator.uid, paramMap=params, defaultParamMap=defaults, numFeatures=len(cuts), numTrees=len(grown))
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTClassificationModel.load(path)
