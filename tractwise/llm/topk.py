"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tractwise.llm.tables import Stored

#: Candidates and queries that one task compares.
BLOCK, QUERIES = 8192, 1024


def threshold_top_k(
    query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int, skip: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` rows of ``vectors`` with the largest inner product, ties to smaller ids.

    ``lists`` holds for each dimension the rows in ascending order. All lists are read
    from the end that favours the query, in steps that double; rows seen for the first
    time are scored. No row unseen can score more than the sum of the products at the
    depth reached, so the search stops when that is less than the kth score: at an equal
    bound it goes on, as an unseen row may win by its id. Row ``skip`` takes no part.
    """
    n = len(ids)
    used = np.flatnonzero(query)
    seen = np.zeros(n, bool)
    if 0 <= skip < n:
        seen[skip] = True
    rows, scores = np.zeros(0, np.int64), np.zeros(0, vectors.dtype)
    depth, step = 0, max(8, k)
    while depth < n and len(used):
        reach = min(n, depth + step)
        near = [lists[d, n - reach: n - depth] if query[d] > 0 else lists[d, depth:reach] for d in used]
        new = np.zeros(n, bool)
        new[np.concatenate(near)] = True
        new &= ~seen
        seen |= new
        new = np.flatnonzero(new)
        rows, scores = np.concatenate([rows, new]), np.concatenate([scores, vectors[new] @ query])
        best = np.lexsort((ids[rows], -scores))[:k]
        rows, scores = rows[best], scores[best]
        last = np.array([lists[d, n - reach] if query[d] > 0 else lists[d, reach - 1] for d in used])
        bound = (vectors[last, used] * query[used]).sum()
        if len(rows) == k and bound < scores[-1]:
            return rows, scores
        depth, step = reach, step * 2
    if not len(used):  # every row scores 0: the smallest ids win
        rows = np.argsort(ids, kind="stable")
        rows = rows[rows != skip][:k]
        scores = np.zeros(len(rows), vectors.dtype)
    return rows, scores


def _searched(k: int, width: int):
    def matrix(column: pd.Series) -> np.ndarray:
        out = np.zeros((len(column), width), np.int64)
        for i, v in enumerate(column):
            out[i, : len(v)] = v
        return out

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = {"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], np.int64)}
        if queries.empty or rows.empty:
            return pd.DataFrame(empty)
        rows = rows.sort_values("vec_id", kind="stable")
        vectors, asked = matrix(rows.ints), matrix(queries.ints)
        # sums below 2 ** 53 are exact as doubles, which multiply faster
        if float(np.abs(vectors).max(initial=0)) * float(np.abs(asked).max(initial=0)) * max(width, 1) < 2.0**53:
            vectors, asked = vectors.astype(np.float64), asked.astype(np.float64)
        ids = rows.vec_id.to_numpy()
        lists = np.argsort(vectors, axis=0, kind="stable").T.copy()
        # equal vectors are one candidate with several ids: their own row is left out below
        parts = []
        for query_id, query in zip(queries.query_id.to_numpy(), asked):
            own = np.searchsorted(ids, query_id)
            skip = own if own < len(ids) and ids[own] == query_id else -1
            at, scores = threshold_top_k(query, vectors, ids, lists, k, skip)
            parts.append((np.full(len(at), query_id), ids[at], scores.astype(np.int64)))
        out = [np.concatenate(x).astype(np.int64) for x in zip(*parts)]
        return pd.DataFrame(dict(zip(empty, out)))
    return run


def top_k(
    vectors: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """For each row whose id is divisible by ``every`` its ``k`` best others, exactly.

    Returns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the inner product of
    the components ``floor(scale * x)``, ties to the smaller id. Rows with a NULL
    vector or id, or a component that is NULL or not finite, take no part; shorter
    vectors, also empty ones, count as filled up with zeros; rows that repeat an id count once (the
    smaller vector). A table of fewer rows gives what there is.

    Equal vectors tie everywhere, so of each different vector only the ``k + 1``
    smallest ids can win: the others are cut in the tasks that read them. Candidates
    and queries go to tasks in blocks, each candidate once for every ``QUERIES`` queries
    and each query once for every ``BLOCK`` candidates, and each task returns ``k`` rows
    a query.
    """
    stored = Stored(vectors.sparkSession)
    x = F.col("v")
    ints = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("bigint"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                     & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = stored(
        vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(sound)
        .groupBy("vec_id").agg(F.min(ints).alias("ints")))
    same = Window.partitionBy("ints").orderBy("vec_id")
    # an own row may be among the smallest ids of its vector, hence one more
    others = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).drop("place")
    queries = rows.where(F.col("vec_id") % every == 0)
    size = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q"),
        F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("width")).first()
    n_rows, n_queries = -(-size["n"] // BLOCK) or 1, -(-size["q"] // QUERIES) or 1

    def block(salt: int, n: int):
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(n)).cast("int")

    def everywhere(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = queries.select(
        F.col("vec_id").alias("query_id"), "ints", block(1, n_queries).alias("a"), everywhere(n_rows).alias("b"))
    held = others.select("vec_id", "ints", block(2, n_rows).alias("b"), everywhere(n_queries).alias("a"))
    found = asked.groupBy("a", "b").cogroup(held.groupBy("a", "b")).applyInPandas(
        _searched(k, size["width"]), "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
