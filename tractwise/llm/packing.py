"""Packing documents into sequences: length patterns fitted by non-negative least squares."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tractwise.llm.tables import Stored
from tractwise.llm.tokens import checksum, default_tokenizer, slices, vocabulary
from tractwise.session import replicated_if_small

#: Pieces of equal length that one task ranks, or so: a frequent length is ranked in as many parts as that takes.
RANKED = 50_000
Pattern = tuple[int, ...]


def _pieces(path: str, size: int, end: int, keep_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]):
        encode = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, begin = encode(part.column("text"), end)
                total = np.diff(begin)
                count = -(-total // size)
                doc = np.repeat(np.arange(len(total)), count)
                piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                # the first piece of a text has what is over
                over = (total - 1) % size + 1
                start = np.where(piece > 0, over[doc] + (piece - 1) * size, 0)
                length = np.where(piece > 0, size, over[doc])
                first = begin[:-1][doc] + start
                cut = [ids[a: a + n] for a, n in zip(first, length)]
                columns = [
                    part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                    pa.array(length), pa.array([checksum(x) for x in cut], pa.int64())]
                if keep_ids:
                    columns.append(pa.array([x.astype("<u4").tobytes() for x in cut], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def pieces(docs: DataFrame, tokenizer: str, size: int, end: int = 0, keep_ids: bool = False) -> DataFrame:
    """Tokens of ``doc_id``, ``text`` in pieces of at most ``size``, each text closed by id ``end``.

    Only a longer text is cut; its first piece has what is over, the others are full.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.mapInArrow(_pieces(tokenizer, size, end, keep_ids), schema + ", ids binary" * keep_ids)


def candidate_patterns(counts: np.ndarray, size: int, grid: int = 64) -> list[Pattern]:
    """Patterns of two and three lengths that occur and fill a sequence exactly.

    All pairs; of triples those whose first two lengths are the most frequent within
    their cells of a grid.
    """
    there = counts > 0
    pairs = [(a, size - a) for a in range(size // 2, size) if there[a] and there[size - a]]
    step = max(1, size // grid)
    cells = [int(np.argmax(counts[c: c + step])) + c for c in range(1, size, step) if counts[c: c + step].any()]
    triples = {tuple(sorted((a, b, size - a - b), reverse=True)) for a in cells for b in cells
               if 0 < size - a - b and there[size - a - b]}
    return pairs + sorted(triples)


def fitted(patterns: list[Pattern], counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeats x >= 0 of the patterns with least squares of (lengths used - ``counts``).

    Projected gradient with Nesterov's momentum on the sparse incidence of patterns and lengths.
    """
    if not patterns:
        return np.zeros(0)
    at = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    length = np.concatenate([np.array(p) for p in patterns])
    goal = counts.astype(float)

    def used(x):
        return np.bincount(length, x[at], len(goal))

    def gradient(x):
        return np.bincount(at, (used(x) - goal)[length], len(patterns))

    vector = np.ones(len(patterns))
    for _ in range(30):  # the largest eigenvalue bounds the step
        vector = np.bincount(at, used(vector)[length], len(patterns))
        top = np.linalg.norm(vector)
        vector /= top
    x = ahead = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, ahead - gradient(ahead) / (1.01 * top))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead, x = new + (before - 1) / t * (new - x), new
    return x


def plan(counts: np.ndarray, size: int) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is packed, together exactly ``counts`` pieces of each length.

    Full pieces stand alone. The others are fitted by patterns, the repeats rounded down
    (and never beyond what is left), and the residuals are packed best first: the longest
    length left, then again and again the longest that still fits, the whole pattern as
    often as its lengths allow. All is arithmetic on at most ``size`` counts.
    """
    left = counts.copy()
    packed = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    patterns = candidate_patterns(left, size)
    repeats = fitted(patterns, left)
    for i in np.argsort(-repeats, kind="stable"):
        lengths, uses = np.unique(patterns[i], return_counts=True)
        times = min(int(repeats[i]), int((left[lengths] // uses).min()))
        if times > 0:
            left[lengths] -= times * uses
            packed.append((patterns[i], times))
    while left.any():
        space, pattern, rest = size, [], left.copy()
        while space > 0:
            fits = np.flatnonzero(rest[1: space + 1])
            if not len(fits):
                break
            best = int(fits[-1]) + 1
            pattern.append(best)
            rest[best] -= 1
            space -= best
        lengths, uses = np.unique(pattern, return_counts=True)
        times = int((left[lengths] // uses).min())
        left[lengths] -= times * uses
        packed.append((tuple(pattern), times))
    return packed


def _slots(packed: list[tuple[Pattern, int]]) -> pd.DataFrame:
    """Where the pieces of each length go: ranks ``low`` to ``high`` to sequences from ``first``."""
    rows, sequence, rank = [], 0, {}
    for pattern, times in packed:
        offset = 0
        for length in pattern:
            low = rank.get(length, 0)
            rows.append((length, low, low + times, sequence, offset))
            rank[length] = low + times
            offset += length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "low", "high", "first", "offset"]).astype("int64")


def packed(parts: DataFrame, size: int, stored: Stored) -> DataFrame:
    """``parts`` (stored, with ``length`` and a number of their own, ``row``) with ``sequence_id`` and ``offset``.

    Full pieces, most of a corpus of long texts, take a sequence of their own each and need
    no rank. Others of equal length are ranked in parts by hash, as many as their number
    asks for, after the counts of the parts before; the driver sees one count per length.
    """
    spark, full = parts.sparkSession, F.col("length") == size
    counts = parts.where(~full).groupBy("length").count().toPandas()
    histogram = np.bincount(counts.length, counts["count"], size + 1).astype(np.int64)
    table = {}
    for row in _slots(plan(histogram, size)).itertuples(index=False):
        table.setdefault(row.length, []).append((int(row.low), int(row.high), int(row.first), int(row.offset)))
    # bounded by the lengths: broadcast
    ranges = F.broadcast(spark.createDataFrame(
        [(int(k), -(-int(histogram[k]) // RANKED), sorted(v)) for k, v in table.items()],
        "length bigint, salts int, ranges array<struct<low: bigint, high: bigint, first: bigint, offset: bigint>>"))
    salted = parts.where(~full).join(ranges, "length").withColumn(
        "salt", F.pmod(F.xxhash64("row"), F.col("salts")))
    sums = salted.groupBy("length", "salt").count()
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(sums.select(
        F.col("length").alias("__length"), F.col("salt").alias("__salt"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")))
    order = Window.partitionBy("length", "salt").orderBy("row")
    ranked = (
        salted.withColumn("rank", F.row_number().over(order) - 1)
        .join(replicated_if_small(before), (F.col("length") == F.col("__length")) & (F.col("salt") == F.col("__salt")))
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    own = F.get(F.filter("ranges", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["high"])), F.lit(0))
    placed = ranked.withColumn("own", own).select(
        *parts.columns, (F.col("own.first") + F.col("rank") - F.col("own.low")).alias("sequence_id"),
        F.col("own.offset").alias("offset"))
    alone = parts.where(full).select(
        "*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return alone.unionByName(placed)


def pack(
    docs: DataFrame, *, tokenizer: str | None = None, size: int = 2048, end: int = 0, keep_ids: bool = False,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """All rows of ``docs`` as pieces of at most ``size`` tokens, placed in sequences.

    Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and, on request, ``ids`` (little-endian unsigned 32-bit). Offsets of a
    sequence have no gaps. NULL and empty texts are the closing id alone. Rows that
    repeat an id, or have none, are packed each for itself. An empty table gives an
    empty result.
    """
    stored = Stored(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    parts = pieces(docs, tokenizer or default_tokenizer(), size, end, keep_ids)
    parts = stored(parts.withColumn("row", F.monotonically_increasing_id()))
    return packed(parts, size, stored).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., keep_ids=True)``: ``sequence_id``,
    ``ids`` and the ``parts`` (``offset``, ``doc_id``, ``piece``, ``length``) they hold."""
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    ordered = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("all"))
    return ordered.select(
        "sequence_id", F.expr("aggregate(all, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
        F.transform("all", lambda x: F.struct(x["offset"], x["doc_id"], x["piece"], x["length"])).alias("parts"))
