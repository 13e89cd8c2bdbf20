"""Simplifying outlines that share borders: arcs between junctions, each seen alike by all its rings."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tractwise.functions.geometry import CHUNK_VERTICES, kept_vertices


def _closed(lon: np.ndarray, lat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which lines are rings: more than three vertices, the last of them the first."""
    closed = lengths > 3
    ends = np.cumsum(lengths)[closed]
    begins = ends - lengths[closed]
    closed[closed] = (lon[begins] == lon[ends - 1]) & (lat[begins] == lat[ends - 1])
    return closed


def _arcs(
    lon: np.ndarray, lat: np.ndarray, lengths: np.ndarray, line: np.ndarray, place: np.ndarray
) -> tuple[np.ndarray, ...]:
    """The arcs of all lines; ``line`` and ``place`` (from the line's begin) are their junctions.

    An arc runs from junction to junction, towards the greater end point; a closed one
    towards the greater of its second points, and without a junction it starts at its
    smallest vertex. So any ring with the same vertices would take it from the same point in
    the same direction. Arrays by arc: begin of its line, vertices around the line, place of
    the arc's first vertex, step (1 or -1) and number of vertices.
    """
    begins = np.cumsum(lengths) - lengths
    closed = _closed(lon, lat, lengths)
    around = np.where(closed, lengths - 1, lengths)  # the closing vertex of a ring is its first one
    open_lines = np.flatnonzero(~closed & (lengths > 0))
    bare = closed.copy()
    bare[line] = False
    # the smallest vertex of each ring without a junction
    bare = np.flatnonzero(bare)
    owner = np.repeat(bare, around[bare])
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(around[bare]) - around[bare], around[bare])
    vertex = begins[owner] + inner
    order = np.lexsort((inner, lat[vertex], lon[vertex], owner))
    smallest = inner[order[np.unique(owner[order], return_index=True)[1]]]
    line = np.concatenate([line, bare, open_lines, open_lines])
    place = np.concatenate([place, smallest, np.zeros(len(open_lines), np.int64), lengths[open_lines] - 1])
    stops = np.unique(np.stack([line, place], 1), axis=0) if len(line) else np.zeros((0, 2), np.int64)
    line, place = stops[:, 0], stops[:, 1]
    if not len(line):
        return (np.zeros(0, np.int64),) * 5
    starts = np.append(True, line[1:] != line[:-1])
    ends = np.append(starts[1:], True)
    # the next stop of a ring's last one is its first one
    following = np.append(place[1:], 0)
    following[ends] = place[starts]
    n = around[line]
    size = np.where(closed[line], (following - place - 1) % n + 2, following - place + 1)
    alone = starts & ends & ~closed[line]
    size[alone] = 1
    real = closed[line] | ~ends | alone
    begin, n, place, size = begins[line][real], n[real], place[real], size[real]

    def at(i):
        vertex = begin + (place + i) % n
        return lon[vertex], lat[vertex]

    less, even = np.zeros(len(size), bool), size > 1
    for (last, first) in zip((*at(size - 1), *at(size - 2)), (*at(0), *at(1))):
        less |= even & (last < first)
        even &= last == first
    return begin, n, np.where(less, place + size - 1, place), np.where(less, -1, 1), size


def kept_on_borders(
    lon: np.ndarray, lat: np.ndarray, lengths: np.ndarray, marks: list[np.ndarray], tolerance_m: float
) -> np.ndarray:
    """Mask of the vertices that stay; ``marks`` are the places of each line's junctions, counted from its begin."""
    line = np.repeat(np.arange(len(marks)), [len(own) for own in marks])
    place = np.concatenate([np.zeros(0, np.int64), *marks]).astype(np.int64)
    return _kept(lon, lat, lengths, line, place, tolerance_m)


def _kept(
    lon: np.ndarray, lat: np.ndarray, lengths: np.ndarray, line: np.ndarray, place: np.ndarray, tolerance_m: float
) -> np.ndarray:
    keep = np.zeros(len(lon), bool)
    begin, n, first, step, size = _arcs(lon, lat, lengths, line, place)
    upto = np.cumsum(size)
    a = 0
    while a < len(size):  # a longer arc is still taken whole
        b = max(a + 1, int(np.searchsorted(upto, upto[a] - size[a] + CHUNK_VERTICES, side="right")))
        counts = size[a:b]
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        of = np.repeat(np.arange(a, b), counts)
        where = begin[of] + (first[of] + step[of] * inner) % n[of]
        keep[where[kept_vertices(lon[where], lat[where], counts, tolerance_m)]] = True
        a = b
    return keep


def simplify_shared_arrow(shapes: pa.Array, marks: pa.Array, tolerance_m: float) -> pa.Array:
    """``shapes`` (lists of points at any depth) without the vertices that no border needs.

    ``marks`` holds, by row, (line, place) of the junctions; lines are counted through the row.
    """
    levels, inner = [], shapes
    while pa.types.is_list(inner.type):
        lengths = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        levels.append((inner, lengths))
        inner = inner.flatten()
    lines = levels[-1][1]
    # the lines of each row, through all levels of nesting
    upto = np.arange(len(lines) + 1)
    for _, lengths in reversed(levels[:-1]):
        upto = upto[np.concatenate([[0], np.cumsum(lengths)])]
    found = marks.flatten()
    row = np.repeat(np.arange(len(marks)), pc.fill_null(pc.list_value_length(marks), 0).to_numpy(zero_copy_only=False))
    line = upto[row] + found.field("line").to_numpy(zero_copy_only=False)
    place = found.field("place").to_numpy(zero_copy_only=False).astype(np.int64)
    lon = inner.field("lon").to_numpy(zero_copy_only=False)
    lat = inner.field("lat").to_numpy(zero_copy_only=False)
    keep = _kept(lon, lat, lines, line, place, tolerance_m)
    # a ring closes at the first vertex it keeps
    ends, closed = np.cumsum(lines), _closed(lon, lat, lines)
    keep[ends[closed] - 1] = False
    upto_kept = np.concatenate([[0], np.cumsum(keep)])
    counts = upto_kept[ends] - upto_kept[ends - lines]
    stay = np.flatnonzero(keep)
    stay = np.insert(stay, upto_kept[ends[closed]], stay[upto_kept[(ends - lines)[closed]]])
    counts[closed] += 1
    inner = inner.take(pa.array(stay))
    for depth, (array, lengths) in enumerate(reversed(levels)):
        sizes = counts if depth == 0 else lengths
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        inner = pa.ListArray.from_arrays(offsets, inner, type=array.type, mask=array.is_null())
    return inner


def _lines(df: DataFrame, shape: str) -> Column:
    """The lines of a shape of any depth as one array."""
    column, kind = F.col(shape), df.schema[shape].dataType
    depth = 0
    while isinstance(kind, T.ArrayType):
        kind, depth = kind.elementType, depth + 1
    if depth == 1:
        return F.array(column)
    for _ in range(depth - 2):
        column = F.flatten(column)
    return column


def _vertices(lines: DataFrame) -> DataFrame:
    """Each vertex of the lines in ``__points`` with its two neighbours, as a hash that does not depend on the
    direction. The closing vertex of a ring is its first one and not listed."""
    points = F.col("__points")
    n = F.size(points)
    closed = F.coalesce((n > 3) & (points[0] == points[n - 1]), F.lit(False))
    lines = lines.where(n > 0).withColumns({"__closed": closed, "__last": n - 1})
    closed, last = F.col("__closed"), F.col("__last")
    nothing = F.slice(points, 1, 0)

    def part(begin, length):
        return F.slice(points, begin, length)

    # a list of neighbours beside the points, so that no lambda runs for each vertex
    listed = F.when(closed, part(F.lit(1), last)).otherwise(points)
    before = F.concat(
        F.when(closed, part(last, F.lit(1))).otherwise(part(F.lit(1), F.lit(1))),
        F.when(closed, part(F.lit(1), F.greatest(last - 1, F.lit(0)))).otherwise(part(F.lit(1), last)))
    after = F.concat(part(F.lit(2), last), F.when(closed, nothing).otherwise(part(F.lit(1), F.lit(1))))
    zipped = F.arrays_zip(listed.alias("p"), before.alias("before"), after.alias("after"))
    names = [c for c in lines.columns if c not in ("__points", "__closed", "__last")]
    rows = lines.select(*names, "__closed", "__last", F.posexplode(zipped).alias("place", "__v"))

    def point(field: str) -> Column:
        return F.xxhash64(F.col(f"__v.{field}.lon") + 0.0, F.col(f"__v.{field}.lat") + 0.0)

    # the ends of an open line have one neighbour
    one = F.when(closed | (F.col("place") > 0), point("before")).otherwise(F.lit(1).cast("bigint"))
    other = F.when(closed | (F.col("place") < last), point("after")).otherwise(F.lit(2).cast("bigint"))
    rows = rows.select(
        *names, "place", (F.col("__v.p.lon") + 0.0).alias("lon"), (F.col("__v.p.lat") + 0.0).alias("lat"),
        one.alias("__one"), other.alias("__other"))
    pair = F.xxhash64(F.least("__one", "__other"), F.greatest("__one", "__other"))
    return rows.select(*names, "place", "lon", "lat", pair.alias("pair"))


def junctions(df: DataFrame, shape: str) -> DataFrame:
    """``g1``, ``g2`` (a hash of the shape) and the ``marks`` (line, place) of the vertices where borders part.

    A vertex is a junction if its two neighbours are not the same ones in all lines through
    it. Least and greatest pair of neighbours are found in each task before anything is
    shuffled, so a point that very many lines share is one row per task; only junctions
    are joined back to the vertices.
    """
    lines = df.where(F.col(shape).isNotNull()).select(
        *_hashes(df, shape), F.posexplode(_lines(df, shape)).alias("line", "__points"))
    vertices = _vertices(lines)
    parting = vertices.groupBy(F.col("lon").alias("__lon"), F.col("lat").alias("__lat")).agg(
        F.min("pair").alias("low"), F.max("pair").alias("high")).where("low != high").select("__lon", "__lat")
    there = (F.col("lon") == F.col("__lon")) & (F.col("lat") == F.col("__lat"))
    # Spark would guess the sizes of both sides by the files of the shapes: neither is broadcast
    return vertices.join(parting.hint("merge"), there).groupBy("g1", "g2").agg(
        F.collect_set(F.struct("line", "place")).alias("marks"))


def _hashes(df: DataFrame, shape: str) -> list[Column]:
    return [F.xxhash64(F.col(shape)).alias("g1"), F.xxhash64(F.lit(1), F.col(shape)).alias("g2")]


def simplified_together(df: DataFrame, shape: str, output: str, tolerance_m: float) -> DataFrame:
    """``df`` with ``output``: its shapes simplified so that borders they share stay shared."""
    marks = junctions(df, shape).select(
        F.col("g1").alias("__g1"), F.col("g2").alias("__g2"), F.col("marks").alias("__marks"))
    tolerance = float(tolerance_m)

    def simplify(shapes: pa.Array, found: pa.Array) -> pa.Array:
        return simplify_shared_arrow(shapes, found, tolerance)

    simple = F.arrow_udf(simplify, df.schema[shape].dataType)(F.col(shape), F.col("__marks"))
    g1, g2 = _hashes(df, shape)
    names = [c for c in df.columns if c != output]
    place = df.columns.index(output) if output in df.columns else len(names)
    joined = df.join(marks.hint("merge"), (g1 == F.col("__g1")) & (g2 == F.col("__g2")), "left")
    columns = [F.col(f"`{c}`") for c in names]
    columns.insert(place, simple.alias(output))
    return joined.select(*columns)


# Executors then need numpy and pyarrow only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
