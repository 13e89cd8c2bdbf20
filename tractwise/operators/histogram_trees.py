"""Regression trees over many rows: MLlib's models, grown from histograms over stored blocks of bins.

MLlib keeps every row as objects, some 60 to 150 bytes each, through all passes of a fit. Here a row
is a byte a feature (two beyond 256 bins) and its target; a pass is one scan of such blocks, whose
histograms are added up per node. The steps are MLlib's: thresholds from the distribution of
each feature, levels of nodes, variance, categories in the order of their mean.
"""

from __future__ import annotations

import math
import sys
import threading
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession

from tractwise.session import scratch_path

#: Blocks take in files what they hold, so that a split's bytes bound its rows.
BLOCK_FILES = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20)}
BLOCK_BYTES = 512 << 10
#: Bytes of histograms that a task holds in one pass; more nodes take more passes.
PASS_BYTES = 128 << 20
#: Bytes of values summarised at a time, and points of a feature's distribution a summary keeps.
SUMMARY_BYTES, POINTS = 32 << 20, 4096
#: Boosted trees after which the remaining targets are stored anew.
STORE_EVERY = 4
#: Poisson(1) of a tree's copies of a row, as bounds of a uniform 32-bit number.
POISSON = np.array([min(2**32 - 1, int(2**32 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)))) for k in range(12)], np.uint32)
#: Up to so many copies are common.
OFTEN = 4
#: Levels of splits of the deepest tree grown here: a row's place is one byte.
MOST_DEPTH = 8
SUBSETS = {
    "all": lambda k: k, "onethird": lambda k: math.ceil(k / 3), "sqrt": lambda k: math.ceil(math.sqrt(k)),
    "log2": lambda k: max(1, math.ceil(math.log2(k)))}
EPSILON = 2.0**-52


class Node:
    """A node: its statistics (weight, sum, sum of squares of targets), and a split once it has one."""

    def __init__(self, stats: Sequence[float]):
        self.stats, self.split, self.gain, self.slot = tuple(stats), None, 0.0, None
        self.feature, self.goes_left, self.left, self.right = -1, None, None, None

    @property
    def mean(self) -> float:
        return self.stats[1] / self.stats[0]

    @property
    def impurity(self) -> float:
        return impurity(*self.stats)


def impurity(weight: float, total: float, squares: float) -> float:
    return (squares - total * total / weight) / weight if weight else 0.0


@dataclass
class Settings:
    """What a tree is grown by."""

    depth: int
    least_rows: int
    least_gain: float
    subset: int
    seed: int
    bootstrap: bool


def placed(node: Node, bins: np.ndarray, other: int):
    """The slot of each row's node, ``other`` where it has none; one number if that holds for all rows.

    At most 256 slots: ``MOST_DEPTH`` levels have no more.
    """
    if node.left is None:
        return np.uint8(other if node.slot is None else node.slot)
    left, right = placed(node.left, bins, other), placed(node.right, bins, other)
    if left.ndim == right.ndim == 0 and left == right:
        return left
    own, last = bins[node.feature], np.count_nonzero(node.goes_left) - 1
    goes = own <= last if node.goes_left[:last + 1].all() else np.take(node.goes_left, own)
    chosen = np.negative(goes.view(np.uint8))  # all bits or none: a choice by them has no branch to guess
    chosen &= left ^ right
    chosen ^= right
    return chosen


def ends(node: Node) -> list[Node]:
    return [node] if node.left is None else [*ends(node.left), *ends(node.right)]


def predicted(tree: Node, bins: np.ndarray):
    """The tree's prediction for each row."""
    found = ends(tree)
    for slot, node in enumerate(found):
        node.slot = slot
    at = placed(tree, bins, 0)
    return np.array([node.mean for node in found]).take(at)


def copies(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often a forest's tree takes each row of a block; the same whenever it is asked."""
    drawn = np.frombuffer(np.random.Generator(np.random.SFC64([seed & (2**63 - 1), tree, block])).bytes(4 * n), np.uint32)
    out = np.zeros(n, np.uint8)
    for bound in POISSON[:OFTEN]:
        out += drawn >= bound
    rare = np.flatnonzero(drawn >= POISSON[OFTEN - 1])
    out[rare] += np.searchsorted(POISSON[OFTEN:], drawn[rare], side="right").astype(np.uint8)
    return out.astype(float)


def blocks(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            target = np.frombuffer(batch.column("target")[i].as_buffer(), np.float64)
            bins = np.frombuffer(batch.column("bins")[i].as_buffer(), kind).reshape(-1, len(target))
            yield batch.column("block")[i].as_py(), target, bins


def condensed(values: np.ndarray, weights: np.ndarray | None = None, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their weights; of more than ``points`` the last of each of ``points`` equal parts, for its part."""
    if weights is None:
        values, weights = np.unique(values, return_counts=True)
        weights = weights.astype(float)
    else:
        values, at = np.unique(values, return_inverse=True)
        weights = np.bincount(at, weights)
    if len(values) <= points:
        return values, weights
    part = np.minimum((np.cumsum(weights) * (points / weights.sum())).astype(np.int64), points - 1)
    last = np.flatnonzero(np.diff(part, append=points))
    return values[last], np.diff(np.cumsum(weights)[last], prepend=0.0)


def thresholds_of(values: np.ndarray, weights: np.ndarray, splits: int) -> np.ndarray:
    """Between values next to each other: all such places, or ``splits`` of them that part the rows evenly."""
    between = (values[1:] + values[:-1]) / 2
    if len(between) <= splits:
        return between
    stride = weights.sum() / (splits + 1)
    found, target, counted = [], stride, np.cumsum(weights)
    for i in range(1, len(values)):
        if abs(counted[i - 1] - target) < abs(counted[i] - target):
            found.append(between[i - 1])
            target += stride
    return np.array(found)


def _summaries(columns: Sequence[int], width: int):
    """One row per feature with its distribution among the task's rows."""
    most = max(1, SUMMARY_BYTES // (8 * width))

    def run(batches: Iterator[pa.RecordBatch]):
        parts: dict[int, list] = {f: [] for f in columns}
        held, rows = [], 0

        def add():
            table = np.concatenate(held)
            for f in columns:
                parts[f].append(condensed(table[:, f]))
                if len(parts[f]) == 64:
                    parts[f] = [condensed(*map(np.concatenate, zip(*parts[f])))]

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                rows += batch.num_rows
            if rows >= most:
                add()
                held, rows = [], 0
        if rows:
            add()
        for f, found in parts.items():
            if found:
                values, weights = condensed(*map(np.concatenate, zip(*found)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f], pa.int32()), pa.array([values.tobytes()]), pa.array([weights.tobytes()])],
                    ["feature", "points", "weights"])
    return run


def _thresholds(splits: int):
    def run(table: pa.Table) -> pa.Table:
        values, weights = (
            np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in table.column(c)]) for c in ("points", "weights"))
        values, at = np.unique(values, return_inverse=True)
        found = thresholds_of(values, np.bincount(at, weights), splits)
        return pa.table({"feature": table.column("feature").slice(0, 1), "thresholds": pa.array([found.tobytes()], pa.binary())})
    return run


def _in_blocks(thresholds: list, kind: str):
    """Blocks of rows: the targets, and a bin a feature, feature by feature."""
    most = max(4096, BLOCK_BYTES // (8 + len(thresholds) * np.dtype(kind).itemsize))

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        at, rows, held = TaskContext.get().partitionId() << 32, 0, []

        def block():
            targets = np.concatenate([b.column("label").to_numpy(zero_copy_only=False) for b in held])
            if not np.isfinite(targets).all():
                raise ValueError("labels must be finite numbers")
            vectors = np.concatenate([
                b.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for b in held])
            bins = np.empty((len(thresholds), len(targets)), kind)
            for f, bounds in enumerate(thresholds):
                bins[f] = vectors[:, f] if bounds is None else np.searchsorted(bounds, vectors[:, f])
            return pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([targets.tobytes()]), pa.array([bins.tobytes()])], ["block", "target", "bins"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= most:
                yield block()
                at, rows, held = at + 1, 0, []
        if rows:
            yield block()
    return run


def _remaining(boosted: list[tuple[float, Node]], kind: str):
    """The blocks with what is left of their targets after the trees."""
    def run(batches: Iterator[pa.RecordBatch]):
        for at, target, bins in blocks(batches, kind):
            for weight, tree in boosted:
                target = target - weight * predicted(tree, bins)
            yield pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([target.tobytes()]), pa.array([bins.tobytes()])], ["block", "target", "bins"])
    return run


def _histograms(
    trees: dict[int, Node], asked: dict[int, list[np.ndarray]], boosted: list[tuple[float, Node]], scale: float, size: int,
    kind: str, seed: int | None,
):
    """For each node in a slot, weight, sum and sum of squares of the targets by feature asked for and bin."""
    def run(batches: Iterator[pa.RecordBatch]):
        sums = {t: {f: np.zeros((3, (len(nodes) + 1) * size)) for f in np.unique(np.concatenate(nodes))} for t, nodes in asked.items()}
        for block, target, bins in blocks(batches, kind):
            for weight, tree in boosted:
                target = target - weight * predicted(tree, bins)
            if scale != 1:
                target = scale * target
            squares = target * target
            for t, found in sums.items():
                other = len(asked[t])
                start = np.broadcast_to(placed(trees[t], bins, other), len(target)).astype(np.int64) * size
                own = None if seed is None else copies(seed, t, block, len(target))
                weighted = (None, target, squares) if own is None else (own, own * target, own * squares)
                for f, into in found.items():
                    at = start + bins[f]
                    for held, values in zip(into, weighted):
                        held += np.bincount(at, values, minlength=len(held))
        for t, nodes in asked.items():
            for slot, features in enumerate(nodes):
                part = np.stack([sums[t][f][:, slot * size:(slot + 1) * size] for f in features])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), pa.array([slot], pa.int32()), pa.array([part.tobytes()])], ["tree", "slot", "sums"])
    return run


def best_split(sums: np.ndarray, features: Sequence[int], bins: Sequence[int], categorical: Sequence[bool], settings: Settings):
    """The node's statistics and its best split: gain, feature, the bins that go left, statistics of both sides; or none."""
    total = sums[0].sum(axis=1)
    best = None
    for own, f in zip(sums, features):
        own = own[:, :bins[f]]
        order = np.arange(bins[f])
        if categorical[f]:  # by mean, those that do not occur last
            order = np.argsort(np.where(own[0] > 0, own[1] / np.where(own[0] > 0, own[0], 1), np.inf), kind="stable")
        left = np.cumsum(own[:, order], axis=1)[:, :-1]
        right = total[:, None] - left
        if not left.size:
            continue
        fits = (left[0] >= settings.least_rows) & (right[0] >= settings.least_rows)
        lw, rw = np.where(fits, left[0], 1), np.where(fits, right[0], 1)
        whole = impurity(*total)
        parts = (left[2] - left[1] ** 2 / lw) / total[0] + (right[2] - right[1] ** 2 / rw) / total[0]
        gain = np.where(fits, whole - parts, -np.inf)
        at = int(np.argmax(gain))
        if fits[at] and gain[at] >= settings.least_gain and (best is None or gain[at] > best[0]):
            goes = np.zeros(max(bins), bool)
            goes[order[:at + 1]] = True
            best = float(gain[at]), int(f), goes, left[:, at], right[:, at]
    return total, best


def _splits(asked: dict[int, list[np.ndarray]], size: int, bins: Sequence[int], categorical: Sequence[bool], settings: Settings):
    names = ["tree", "slot", "gain", "feature", "goes", "stats"]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t, slot = (k.as_py() for k in key)
        features = asked[t][slot]
        sums = sum(np.frombuffer(x.as_buffer(), np.float64) for x in table.column("sums")).reshape(len(features), 3, size)
        total, best = best_split(sums, features, bins, categorical, settings)
        gain, feature, goes, left, right = best or (0.0, -1, np.zeros(0, bool), total, total)
        return pa.Table.from_arrays([
            pa.array([t], pa.int32()), pa.array([slot], pa.int32()), pa.array([gain]), pa.array([feature], pa.int32()),
            pa.array([goes.tobytes()], pa.binary()), pa.array([np.concatenate([total, left, right]).tobytes()], pa.binary())], names)
    return run


class HistogramTrees:
    """Fits tree regressors to stored rows of a label and a vector; what fits share is made once.

    ``can_fit`` says which: single trees, forests with whole bootstraps and trees boosted on squares, without
    weights or held-out rows of their own. Others are for MLlib.
    """

    def __init__(self, rows: DataFrame, count: int, *, label: str, vector: str):
        self.spark, self.count, self.rows = rows.sparkSession, count, rows
        self.label, self.vector = label, vector
        attributes = rows.schema[vector].metadata["ml_attr"]
        self.width, kinds = attributes["num_attrs"], attributes.get("attrs", {})
        self.arity = {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in kinds.get("nominal", [])}
        self.arity |= {a["idx"]: 2 for a in kinds.get("binary", [])}
        self._stored, self._lock = {}, threading.Lock()

    @staticmethod
    def can_fit(regressor: Estimator) -> bool:
        if type(regressor) not in (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor):
            return False
        get = lambda name, default: regressor.getOrDefault(name) if regressor.hasParam(name) and regressor.isDefined(name) else default
        return (
            get("maxDepth", 0) <= MOST_DEPTH and get("subsamplingRate", 1.0) == 1.0 and get("minWeightFractionPerNode", 0.0) == 0.0
            and get("impurity", "variance") == "variance" and get("lossType", "squared") == "squared"
            and get("featureSubsetStrategy", "auto") in ("auto", *SUBSETS)
            and not get("weightCol", None) and not get("validationIndicatorCol", None) and not get("leafCol", None))

    def _binned(self, max_bins: int) -> tuple[str, list, list[int], str]:
        """Where the blocks are, the thresholds by feature (None for a category), the bins by feature, and a bin's type."""
        with self._lock:
            if max_bins not in self._stored:
                numeric = [f for f in range(self.width) if f not in self.arity]
                rows = self.rows.select(self.rows[self.label].alias("label"), vector_to_array(self.vector).alias("vector"))
                thresholds: list = [None] * self.width
                if numeric:
                    points = rows.select("vector").mapInArrow(
                        _summaries(numeric, self.width), "feature int, points binary, weights binary")
                    found = points.groupBy("feature").applyInArrow(
                        _thresholds(min(max_bins, self.count) - 1), "feature int, thresholds binary").collect()
                    for r in found:
                        thresholds[r.feature] = np.frombuffer(bytes(r.thresholds), np.float64)
                bins = [self.arity[f] if t is None else len(t) + 1 for f, t in enumerate(thresholds)]
                kind = "uint8" if max(bins) <= 256 else "uint16"
                path = scratch_path(self.spark, "blocks")
                rows.mapInArrow(_in_blocks(thresholds, kind), BLOCKS).write.options(**BLOCK_FILES).parquet(path)
                self._stored[max_bins] = path, thresholds, bins, kind
            return self._stored[max_bins]

    def _grow(self, binned, path: str, count: int, settings: Settings, boosted=(), scale: float = 1.0) -> list[Node]:
        """``count`` trees, level by level."""
        _, _, bins, kind = binned
        size, categorical = max(bins), [f in self.arity for f in range(self.width)]
        stored = self.spark.read.schema(BLOCKS).parquet(path)
        roots = {t: Node((0, 0, 0)) for t in range(count)}
        frontier = [(t, root) for t, root in roots.items()]
        draws = np.random.default_rng(settings.seed & (2**63 - 1))
        for level in range(settings.depth + 1):
            following = []
            most = max(1, PASS_BYTES // (24 * size * self.width))
            for start in range(0, len(frontier), most):
                asked: dict[int, list[np.ndarray]] = {}
                at = {}
                for t, node in frontier[start:start + most]:
                    nodes = asked.setdefault(t, [])
                    node.slot, at[t, len(nodes)] = len(nodes), node
                    nodes.append(np.sort(draws.choice(self.width, settings.subset, replace=False)))
                shipped = {t: roots[t] for t in asked}
                passed = stored.mapInArrow(
                    _histograms(shipped, asked, list(boosted), scale, size, kind, settings.seed if settings.bootstrap else None),
                    "tree int, slot int, sums binary")
                for r in passed.groupBy("tree", "slot").applyInArrow(
                    _splits(asked, size, bins, categorical, settings),
                    "tree int, slot int, gain double, feature int, goes binary, stats binary",
                ).collect():
                    stats = np.frombuffer(bytes(r.stats), np.float64).reshape(3, 3)
                    node = at[r.tree, r.slot]
                    node.stats = tuple(stats[0])
                    if r.feature >= 0 and r.gain > 0 and level < settings.depth:
                        node.gain, node.feature = r.gain, r.feature
                        node.goes_left = np.frombuffer(bytes(r.goes), bool)
                        node.left, node.right = Node(stats[1]), Node(stats[2])
                        if level + 1 < settings.depth:
                            following += [(r.tree, n) for n in (node.left, node.right) if abs(n.impurity) >= EPSILON]
                for node in at.values():
                    node.slot = None
            frontier = sorted(following, key=lambda x: x[0])
            if not frontier:
                break
        return list(roots.values())

    def fit(self, regressor: Estimator) -> Model:
        binned = self._binned(regressor.getMaxBins())
        path, thresholds, bins, kind = binned
        forest, boost = isinstance(regressor, RandomForestRegressor), isinstance(regressor, GBTRegressor)
        count = regressor.getNumTrees() if forest else 1
        subset = regressor.getFeatureSubsetStrategy() if forest or boost else "all"
        if subset == "auto":
            subset = "onethird" if forest and count > 1 else "all"
        settings = Settings(
            regressor.getMaxDepth(), regressor.getMinInstancesPerNode(), regressor.getMinInfoGain(), SUBSETS[subset](self.width),
            regressor.getSeed(), forest and regressor.getBootstrap())
        build = _Models(self.spark, thresholds, self.arity, self.width)
        if not boost:
            trees = self._grow(binned, path, count, settings)
            return build.forest(regressor, trees) if forest else build.tree(regressor, trees[0])
        boosted, waiting = [], []
        for i in range(regressor.getMaxIter()):
            if len(waiting) == STORE_EVERY:
                target = scratch_path(self.spark, "blocks")
                self.spark.read.schema(BLOCKS).parquet(path).mapInArrow(_remaining(waiting, kind), BLOCKS).write.options(
                    **BLOCK_FILES).parquet(target)
                path, waiting = target, []
            settings.seed = regressor.getSeed() + i
            # the first tree meets the label, the others the negative gradient of the squared error
            tree = self._grow(binned, path, 1, settings, waiting, 2.0 if i else 1.0)[0]
            waiting.append((regressor.getStepSize() if i else 1.0, tree))
            boosted.append(waiting[-1])
        return build.boosted(regressor, boosted)


BLOCKS = "block bigint, target binary, bins binary"


class _Models:
    """MLlib's models of grown trees."""

    def __init__(self, spark: SparkSession, thresholds: list, arity: dict[int, int], width: int):
        self.gateway, ml = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml
        # each of these names is a question to the JVM: asked once
        self.leaf, self.internal = ml.tree.LeafNode, ml.tree.InternalNode
        self.continuous, self.categorical = ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
        self.calculator = spark._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        self.tree_model, self.forest_model, self.boosted_model = (
            ml.regression.DecisionTreeRegressionModel, ml.regression.RandomForestRegressionModel, ml.regression.GBTRegressionModel)
        self.double = self.gateway.jvm.double
        self.thresholds, self.arity, self.width = thresholds, arity, width

    def _doubles(self, values: Sequence[float]):
        out = self.gateway.new_array(self.double, len(values))
        for i, value in enumerate(values):
            out[i] = float(value)
        return out

    def _node(self, node: Node):
        stats = self.calculator(self._doubles(node.stats), round(node.stats[0]))
        if node.left is None or _flat(node):
            return self.leaf(float(node.mean), float(node.impurity), stats)
        f = node.feature
        if f in self.arity:
            split = self.categorical(f, self._doubles(np.flatnonzero(node.goes_left[:self.arity[f]])), self.arity[f])
        else:
            split = self.continuous(f, float(self.thresholds[f][np.count_nonzero(node.goes_left) - 1]))
        return self.internal(
            float(node.mean), float(node.impurity), float(node.gain), self._node(node.left), self._node(node.right), split, stats)

    def _tree(self, root: Node):
        return self.tree_model(self._node(root), self.width)

    def _trees(self, roots: Sequence[Node]):
        out = self.gateway.new_array(self.tree_model, len(roots))
        for i, root in enumerate(roots):
            out[i] = self._tree(root)
        return out

    def tree(self, regressor: Estimator, root: Node) -> Model:
        return regressor._copyValues(DecisionTreeRegressionModel(self._tree(root)))

    def forest(self, regressor: Estimator, roots: Sequence[Node]) -> Model:
        made = self.forest_model(regressor.uid, self._trees(roots), self.width)
        return regressor._copyValues(RandomForestRegressionModel(made))

    def boosted(self, regressor: Estimator, trees: Sequence[tuple[float, Node]]) -> Model:
        made = self.boosted_model(
            regressor.uid, self._trees([t for _, t in trees]), self._doubles([w for w, _ in trees]), self.width)
        return regressor._copyValues(GBTRegressionModel(made))


def _flat(node: Node) -> bool:
    """Whether all ends below the node predict the same."""
    return node.left is None or (_flat(node.left) and _flat(node.right) and ends(node.left)[0].mean == ends(node.right)[0].mean)


# Executors then need numpy and pyarrow only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
