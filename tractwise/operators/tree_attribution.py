"""Exact Shapley values of linear and tree models against one baseline row."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from tractwise.operators.models import FILLED, VECTOR
from tractwise.session import scratch_path

STRUCT = "feature_importance"
TREES = (DecisionTreeRegressionModel, RandomForestRegressionModel, GBTRegressionModel)
#: What the preparing stages put before a feature's name.
PREFIXES = (FILLED, "__index_", "__hot_", "__cut_")


def can_be_exact(model: PipelineModel) -> bool:
    return isinstance(model.stages[-1], (LinearRegressionModel, *TREES))


def tree_nodes(spark: SparkSession, model) -> DataFrame:
    """The nodes of a tree model as a table: ``tree``, ``weight``, ``id``, ``prediction``, ``left``, ``right``
    (-1 at a leaf), ``slot``, ``threshold`` (goes left up to it) or ``categories`` (go left)."""
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = nodes.withColumn("tree", F.lit(0))
    weights = [1.0]
    if isinstance(model, RandomForestRegressionModel):
        weights = [1.0 / model.getNumTrees] * model.getNumTrees
    elif isinstance(model, GBTRegressionModel):
        weights = list(model.treeWeights)
    categorical = F.col("split.numCategories") != -1
    return nodes.select(
        "tree", F.get(F.lit(weights).cast("array<double>"), F.col("tree")).alias("weight"), "id", "prediction",
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("split.featureIndex").alias("slot"),
        F.when(~categorical, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(categorical, F.col("split.leftCategoriesOrThreshold")).alias("categories"))


class Leaf:
    """A leaf's weighted value and, by feature, the (node, goes left) that its path asks for."""

    __slots__ = ("value", "asks")

    def __init__(self, value: float, asks: dict[int, list[tuple[int, bool]]]):
        self.value, self.asks = value, asks


def leaves(rows: list, players: Sequence[int]) -> tuple[dict[int, tuple], list[Leaf]]:
    """The splits (slot, threshold, categories) of one tree by node, and its leaves.

    ``players`` gives the feature of each slot of the vector: slots of one feature are in
    or out of a coalition together.
    """
    nodes = {r.id: r for r in rows}
    splits, found, paths = {}, [], [(0, ())]
    while paths:
        at, path = paths.pop()
        node = nodes[at]
        if node.left < 0:
            asks: dict[int, list[tuple[int, bool]]] = {}
            for split, goes_left in path:
                asks.setdefault(players[splits[split][0]], []).append((split, goes_left))
            found.append(Leaf(node.weight * node.prediction, asks))
            continue
        splits[at] = (node.slot, node.threshold, None if node.categories is None else np.array(node.categories))
        paths += [(node.left, (*path, (at, True))), (node.right, (*path, (at, False)))]
    return splits, found


def _goes_left(vectors: np.ndarray, splits: dict[int, tuple]) -> dict[int, np.ndarray]:
    return {
        at: np.isin(vectors[:, slot], categories) if categories is not None else vectors[:, slot] <= threshold
        for at, (slot, threshold, categories) in splits.items()}


def shapley_of_trees(vectors: np.ndarray, base: np.ndarray, trees: list[tuple[dict, list[Leaf]]], n: int) -> np.ndarray:
    """Shapley values of ``n`` features for each row of ``vectors``, features that are out having the values of ``base``.

    A coalition reaches a leaf if it holds every feature that only the row's value lets
    pass (A) and none that only the baseline's does (N). Such a game has known values: with
    p = \\|A\\| and q = \\|N\\|, each of A gains ``(p - 1)! q! / (p + q)!`` of the leaf and each
    of N loses ``p! (q - 1)! / (p + q)!``. What passes both ways does not matter, and a leaf
    that neither lets pass is never reached. The sum over leaves is exact, at a cost of
    leaves times depth.
    """
    out = np.zeros((len(vectors), n))
    for splits, found in trees:
        own, other = _goes_left(vectors, splits), _goes_left(base[None, :], splits)
        for leaf in found:
            alive, p = np.ones(len(vectors), bool), 0
            gains, losses, q = [], [], np.zeros(len(vectors), np.int64)
            for feature, asked in leaf.asks.items():
                passes = np.logical_and.reduce([own[at] == left for at, left in asked])
                if all(other[at][0] == left for at, left in asked):
                    losses.append((feature, ~passes))
                    q += ~passes
                else:
                    gains.append(feature)
                    alive &= passes
                    p += 1
            if not alive.any():
                continue
            sizes = range(len(losses) + 1)
            if p:
                gain = np.array([math.factorial(p - 1) * math.factorial(k) / math.factorial(p + k) for k in sizes])
                each = leaf.value * gain[q] * alive
                for feature in gains:
                    out[:, feature] += each
            loss = np.array([0.0, *[
                math.factorial(p) * math.factorial(k - 1) / math.factorial(p + k) for k in sizes if k]])
            each = leaf.value * loss[q] * alive
            for feature, lost in losses:
                out[:, feature] -= each * lost
    return out


def _attributed(keys: list[str], names: list[str], score):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                vectors = batch.column("__vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                parts = score(vectors)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k) for k in keys], *[pa.array(parts[:, i]) for i in range(len(names))]],
                    [*keys, *names])
    return run


def exact_attributions(
    df: DataFrame, model: PipelineModel, *, baseline: Mapping[str, float | str | None], features: Sequence[str],
    keys: Sequence[str],
) -> DataFrame:
    """``keys`` and the struct of exact Shapley values of ``features``, for a linear model, a tree, a forest or boosted trees.

    The parts of a row add up to its prediction minus the one at ``baseline``. Each row is
    read once and nothing is shuffled: the model's nodes, bounded by its trees and their
    depth, go to every task. A feature the model does not use has 0. NULLs count as what
    the model fills in for them.
    """
    spark, features, keys = df.sparkSession, list(features), list(keys)
    *prepare, regression = model.stages
    if not can_be_exact(model):
        raise ValueError("needs a linear or tree model; use sampled_attributions")
    prepared = PipelineModel(stages=prepare)
    types = {field.name: field.dataType for field in df.schema}
    at_base = prepared.transform(
        spark.range(1).select(*[F.lit(baseline[c]).cast(types[c]).alias(c) for c in features])).first()
    players = []
    for column in prepare[-1].getInputCols():
        feature = next(column.removeprefix(p) for p in PREFIXES if column.startswith(p))
        value = at_base[column]
        players += [features.index(feature)] * (len(value) if hasattr(value, "toArray") else 1)
    base, n = at_base[VECTOR].toArray(), len(features)

    if isinstance(regression, LinearRegressionModel):
        weights = regression.coefficients.toArray()
        owner = np.zeros((len(players), n))
        owner[np.arange(len(players)), players] = 1

        def score(vectors: np.ndarray) -> np.ndarray:
            return ((vectors - base) * weights) @ owner
    else:
        by_tree: dict[int, list] = {}
        for row in tree_nodes(spark, regression).collect():  # bounded by the model's own size
            by_tree.setdefault(row.tree, []).append(row)
        trees = [leaves(rows, players) for rows in by_tree.values()]

        def score(vectors: np.ndarray) -> np.ndarray:
            return shapley_of_trees(vectors, base, trees, n)

    key_names, names = [f"__key_{i}" for i in range(len(keys))], [f"__part_{i}" for i in range(n)]
    vectors = prepared.transform(
        df.select(*[F.col(k).alias(a) for k, a in zip(keys, key_names)], *features)
    ).select(*key_names, vector_to_array(VECTOR).alias("__vector"))
    kept = ", ".join(f"`{a}` {vectors.schema[a].dataType.simpleString()}" for a in key_names)
    parts = vectors.mapInArrow(
        _attributed(key_names, names, score), ", ".join(filter(None, [kept, *[f"{c} double" for c in names]])))
    return parts.select(
        *[F.col(a).alias(k) for k, a in zip(keys, key_names)],
        F.struct(*[F.col(c).alias(f) for c, f in zip(names, features)]).alias(STRUCT))


# Executors then need numpy and pyarrow only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
