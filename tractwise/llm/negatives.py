"""Hard negatives for contrastive training: windows of inner products searched in STR-packed R-trees."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tractwise.llm.tables import Stored
from tractwise.session import replicated_if_small

#: Rows of a tree and anchors that one task compares.
BLOCK, ANCHORS = 8192, 1024
#: Rows of a leaf, and boxes of an inner node.
LEAF, FAN = 128, 16
#: Coordinates by which the rows of a label are tiled before they become trees.
TILED = 2


def packed_order(vectors: np.ndarray, capacity: int) -> np.ndarray:
    """Rows in sort-tile-recursive order: consecutive runs of ``capacity`` are the leaves.

    Rows are sorted by the coordinate that spreads most and cut into slabs of whole leaves,
    each slab by the next coordinate, and so on, as many times as there are leaves for.
    """
    spread = np.argsort(-vectors.var(axis=0), kind="stable") if len(vectors) else np.zeros(0, np.int64)
    levels = max(1, min(len(spread), int(math.log2(max(2, len(vectors) / capacity)) // 2)))

    def tiled(rows: np.ndarray, level: int) -> list[np.ndarray]:
        if len(spread):
            rows = rows[np.argsort(vectors[rows, spread[level]], kind="stable")]
        leaves = -(-len(rows) // capacity)
        if level + 1 >= levels or leaves <= 1:
            return [rows]
        slabs = math.ceil(leaves ** (1 / (levels - level)))
        step = -(-leaves // slabs) * capacity
        return [x for at in range(0, len(rows), step) for x in tiled(rows[at: at + step], level + 1)]

    return np.concatenate(tiled(np.arange(len(vectors)), 0)) if len(vectors) else np.zeros(0, np.int64)


class Tree:
    """An R-tree over integer vectors, packed bottom up: leaves of ``LEAF`` rows, nodes of ``FAN`` boxes."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        order = packed_order(vectors, LEAF)
        self.vectors, self.ids = vectors[order], ids[order]
        low, high, n, step = self.vectors, self.vectors, len(ids), LEAF
        #: The boxes of each level, leaves first; box i of a level holds the boxes (or rows) from i * step.
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        while n:
            at = np.arange(0, n, step)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            self.levels.append((low, high, step))
            n, step = len(at), FAN
            if n == 1:
                break

    def asked(self, query: np.ndarray) -> Search:
        return Search(self, query)


class Search:
    """One query's searches of a tree; intervals of boxes and scores of leaves are computed once."""

    def __init__(self, tree: Tree, query: np.ndarray):
        self.tree, self.query = tree, query
        self.up, self.down = np.maximum(query, 0), np.minimum(query, 0)
        self.intervals: dict[tuple[int, int], tuple[list, list]] = {}
        self.scores: dict[int, np.ndarray] = {}

    def _boxes(self, level: int, first: int, last: int) -> tuple[list, list]:
        """The least and the largest inner product possible in each of a level's boxes: each
        coordinate adds an interval of its own."""
        key = (level, first)
        if key not in self.intervals:
            low, high = (x[first:last] for x in self.tree.levels[level][:2])
            self.intervals[key] = ((low @ self.up + high @ self.down).tolist(), (high @ self.up + low @ self.down).tolist())
        return self.intervals[key]

    def best(self, k: int, least, most, skip=None) -> list[tuple[int, int]]:
        """``(score, id)`` of the ``k`` rows with the highest scores from ``least`` to ``most``, ties to smaller ids.

        Boxes are taken in the order of the best score they can hold. A box goes unread if
        its interval lies outside the window, or if that score is strictly below the kth
        found: at an equal one a row may still win by its id. Row ``skip`` takes no part.
        """
        tree = self.tree
        found: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first
        queue: list[tuple] = []

        def enter(level: int, first: int, last: int) -> None:
            for i, (low, high) in enumerate(zip(*self._boxes(level, first, last)), first):
                if high >= least and low <= most and not (len(found) == k and high < found[0][0]):
                    heapq.heappush(queue, (-min(high, most), level, i))

        if tree.levels:
            enter(len(tree.levels) - 1, 0, 1)
        while queue:
            bound, level, i = heapq.heappop(queue)
            if len(found) == k and -bound < found[0][0]:
                break
            step = tree.levels[level][2]
            first = i * step
            if level:
                enter(level - 1, first, min(first + step, len(tree.levels[level - 1][0])))
                continue
            if i not in self.scores:
                self.scores[i] = tree.vectors[first: first + step] @ self.query
            scores = self.scores[i]
            floor = max(least, found[0][0]) if len(found) == k else least
            for at in np.flatnonzero((scores >= floor) & (scores <= most)).tolist():
                row = (int(scores[at]), -int(tree.ids[first + at]))
                if row[1] == (None if skip is None else -skip):
                    continue
                if len(found) < k:
                    heapq.heappush(found, row)
                elif row > found[0]:
                    heapq.heapreplace(found, row)
        return [(score, -negated) for score, negated in sorted(found, reverse=True)]


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _searched(k: int, width: int, windows: bool, low: int, high: int):
    """Searches of a block of rows for a block of anchors: the best others, or the best within each window."""
    names = ["anchor_id", *["positive_id", "positive_score"] * windows, "vec_id", "score"]

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            vectors, asked = _matrix(rows.ints, width), _matrix(anchors.ints, width)
            # sums below 2 ** 53 are exact as doubles, which multiply faster
            if float(np.abs(vectors).max(initial=0)) * float(np.abs(asked).max(initial=0)) * max(width, 1) < 2.0**53:
                vectors, asked = vectors.astype(np.float64), asked.astype(np.float64)
            tree = Tree(vectors, rows.vec_id.to_numpy())
            for at, (anchor, query) in enumerate(zip(anchors.anchor_id.tolist(), asked)):
                search = tree.asked(query)
                if not windows:
                    out += [(anchor, i, s) for s, i in search.best(k, -math.inf, math.inf, anchor)]
                    continue
                for p in anchors.positives.iat[at]:
                    score = int(p["score"])
                    least, most = -(-low * score // 100), high * score // 100
                    if least <= most:
                        found = search.best(k, least, most)
                        out += [(anchor, int(p["vec_id"]), score, i, s) for s, i in found]
        return pd.DataFrame(out, columns=names).astype("int64")
    return run


def _tile(rows: DataFrame, stored: Stored) -> DataFrame:
    """``rows`` with ``block``: one label's rows of a tile, ``BLOCK`` or so, each block near in space.

    A label is cut into slabs of equal counts by one coordinate and each slab by another,
    by percentiles. Of a tile with more rows than a block (many equal coordinates) the
    rows are dealt out by hash, so no task holds more whatever the values.
    """
    def part(at: int, cuts: Column, parts: Column) -> Column:
        value = F.coalesce(F.get("ints", F.lit(at)), F.lit(0).cast("bigint"))
        return F.when(parts <= 1, 0).otherwise(F.size(F.filter(cuts, lambda c: c < value)))

    keys, tiled = ["label"], rows
    for at in range(TILED):
        value = F.coalesce(F.get("ints", F.lit(at)), F.lit(0).cast("bigint"))
        # blocks of a label, as a root for each coordinate still to come
        parts = F.ceil(F.pow(F.col("n") / BLOCK, F.lit(1 / (TILED - at)))).cast("int")
        grid = F.array(*[F.lit(i / 64) for i in range(1, 64)])
        cuts = tiled.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx(value, grid, 1000).alias("all"))
        # of 63 percentiles those that part evenly; more parts than 64 come from the deal by hash
        chosen = F.when(parts <= 1, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(1), F.least(parts, F.lit(64)) - 1),
            lambda i: F.get("all", F.floor(i * 64 / F.least(parts, F.lit(64))).cast("int") - 1)))
        cuts = stored(cuts.select(*[F.col(c).alias(f"__{c}") for c in keys], chosen.alias("cuts"), parts.alias("parts")))
        same = [F.col(c) == F.col(f"__{c}") for c in keys]
        tiled = tiled.join(replicated_if_small(cuts), same).withColumn(
            f"t{at}", part(at, F.col("cuts"), F.col("parts"))).drop("cuts", "parts", *[f"__{c}" for c in keys])
        keys.append(f"t{at}")
    deal = stored(tiled.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("deal")))
    deal = deal.select(*[F.col(c).alias(f"__{c}") for c in keys], "deal")
    same = [F.col(c) == F.col(f"__{c}") for c in keys]
    dealt = F.pmod(F.xxhash64("vec_id"), F.col("deal"))
    return tiled.join(replicated_if_small(deal), same).select(
        "vec_id", "label", "ints", F.xxhash64(*keys, dealt).alias("block"))


def hard_negatives(
    vectors: DataFrame, *, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives, exactly.

    A row's components become ``floor(scale * x)``, its score is the integer inner product
    with the anchor; higher scores come first, ties by smaller id. Anchors are the rows
    whose id is divisible by ``every``. An anchor's positives are its first ``positives``
    other rows of the same label; for each, the negatives are the first ``negatives`` rows
    of another label with ``low`` % to ``high`` % of the positive's score (none, if that is
    negative). Returns ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``,
    ``positive_score``, ``negative_score``.

    Rows with a NULL id, label or vector, or a component that is NULL or not finite, take
    no part. Empty vectors score 0 and shorter ones count as filled up with zeros. Rows
    that repeat an id count once (the smallest label and vector). Fewer rows give what
    there is; an empty table gives an empty result. Only the three columns are read.

    Equal vectors of a label tie everywhere, so only the smallest ids of each can win: the
    others are cut in the tasks that read them. Rows are tiled in space into blocks of one
    label; a task builds the R-tree of a block and searches it for a block of anchors,
    first for the positives in their own label, then in the others for the windows.
    """
    stored = Stored(vectors.sparkSession)
    ints = F.transform("v", lambda c: F.floor(c.cast("double") * scale).cast("bigint"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                     & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = stored(
        vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(label_column).cast("bigint").alias("label"),
                       F.col(vector_column).alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(sound)
        .groupBy("vec_id").agg(F.min(F.struct("label", ints.alias("ints"))).alias("row"))
        .select("vec_id", "row.label", "row.ints"))
    same = Window.partitionBy("label", "ints").orderBy("vec_id")
    # an anchor may be among the smallest ids of its vector, hence one more
    most = max(positives + 1, negatives)
    held = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= most).drop("place")
    held = stored(_tile(stored(held), stored))
    anchors = rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "anchor_id")
    size = rows.agg(
        F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("anchors"),
        F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("width")).first()
    groups = -(-size["anchors"] // ANCHORS) or 1
    group = F.pmod(F.xxhash64("anchor_id"), F.lit(groups)).cast("int").alias("a")
    blocks = replicated_if_small(stored(held.select(F.col("label").alias("block_label"), "block").distinct()))
    copies = held.select("vec_id", "ints", "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("a"))

    def searched(asked: DataFrame, columns: str, k: int, windows: bool) -> DataFrame:
        return asked.groupBy("block", "a").cogroup(copies.groupBy("block", "a")).applyInPandas(
            _searched(k, size["width"], windows, low, high), columns)

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    own = anchors.join(blocks, F.col("label") == F.col("block_label")).select("anchor_id", "ints", "block", group)
    near = first(searched(own, "anchor_id bigint, vec_id bigint, score bigint", positives, False), ["anchor_id"], positives)
    goals = stored(near.groupBy(F.col("anchor_id").alias("__anchor")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives")))
    goals = anchors.join(goals, F.col("anchor_id") == F.col("__anchor"))
    others = goals.join(blocks, F.col("label") != F.col("block_label")).select(
        "anchor_id", "ints", "positives", "block", group)
    far = searched(
        others, "anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint", negatives, True)
    return first(far, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
