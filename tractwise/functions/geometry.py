"""Boundary generalisation on Arrow batches."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS_M = 6371008.8

#: Vertices worked on at a time; one longer line is still taken whole.
CHUNK_VERTICES = 1_000_000


def kept_vertices(
    lon: np.ndarray, lat: np.ndarray, lengths: np.ndarray, tolerance_m: float
) -> np.ndarray:
    """Mask of the vertices Douglas-Peucker keeps on many lines or rings at once.

    ``lengths`` are the vertex counts of the consecutive lines. Distances are
    metres in an equirectangular projection around each line's mean latitude.
    End points always stay; a closed ring is split at its vertex farthest from
    the start. All open spans of all lines are measured together, one round per
    level of splitting.
    """
    lengths = lengths[lengths > 0]
    keep = np.zeros(len(lon), dtype=bool)
    if not len(lengths):
        return keep
    first = np.cumsum(lengths) - lengths
    last = first + lengths - 1
    keep[first] = keep[last] = True
    centre = np.add.reduceat(lat, first) / lengths
    y = np.radians(lat) * EARTH_RADIUS_M
    x = np.radians(lon) * EARTH_RADIUS_M * np.cos(np.radians(np.repeat(centre, lengths)))
    while True:
        open_spans = last - first > 1
        first, last = first[open_spans], last[open_spans]
        if not len(first):
            return keep
        inner = last - first - 1
        begin = np.cumsum(inner) - inner
        span = np.repeat(np.arange(len(first)), inner)
        vertex = np.arange(len(span)) + np.repeat(first + 1 - begin, inner)
        dx, dy = x[last] - x[first], y[last] - y[first]
        length2 = dx * dx + dy * dy
        px, py = x[vertex] - x[first][span], y[vertex] - y[first][span]
        along = (px * dx[span] + py * dy[span]) / np.where(length2 > 0, length2, 1.0)[span]
        along = np.clip(along, 0.0, 1.0)
        away2 = (px - along * dx[span]) ** 2 + (py - along * dy[span]) ** 2
        farthest = np.maximum.reduceat(away2, begin)
        at_farthest = np.flatnonzero(away2 == farthest[span])
        _, leading = np.unique(span[at_farthest], return_index=True)
        split = vertex[at_farthest[leading]]
        beyond = farthest > tolerance_m * tolerance_m
        split = split[beyond]
        keep[split] = True
        first, last = (
            np.concatenate([first[beyond], split]), np.concatenate([split, last[beyond]])
        )


def simplify_arrow(shapes: pa.Array, tolerance_m: float) -> pa.Array:
    """Simplify a list array of ``{lon, lat}`` points, at any depth of nesting
    (line or ring; polygon of rings; collection of polygons)."""
    lengths = pc.fill_null(pc.list_value_length(shapes), 0).to_numpy(zero_copy_only=False)
    inner = shapes.flatten()
    if pa.types.is_list(shapes.type.value_type):
        inner = simplify_arrow(inner, tolerance_m)
    else:
        lon = inner.field("lon").to_numpy(zero_copy_only=False)
        lat = inner.field("lat").to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        chunks = np.unique(starts[:-1] // CHUNK_VERTICES, return_index=True)[1]
        keep = np.concatenate([
            kept_vertices(
                lon[starts[a]:starts[b]], lat[starts[a]:starts[b]], lengths[a:b], tolerance_m
            )
            for a, b in zip(chunks, [*chunks[1:], len(lengths)])
        ]) if len(lengths) else np.zeros(0, dtype=bool)
        inner = inner.filter(pa.array(keep))
        kept_before = np.concatenate([[0], np.cumsum(keep)])
        lengths = kept_before[starts[1:]] - kept_before[starts[:-1]]
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, inner, type=shapes.type, mask=shapes.is_null())


POLYGONS = "array<array<array<struct<lon: double, lat: double>>>>"


def polygons_from_wkt(text: Column | str) -> Column:
    """The polygons of a ``POLYGON`` or ``MULTIPOLYGON`` text as nested arrays
    (polygons, rings, points), by built-in functions. Other shapes fail."""
    text = F.trim(F.col(text) if isinstance(text, str) else text)
    kind = F.upper(F.regexp_extract(text, r"^([A-Za-z]+)", 1))
    points = F.regexp_replace(
        F.regexp_extract(text, r"^[A-Za-z]+\s*(\(.*\))$", 1),
        r"([-+0-9.eE]+)\s+([-+0-9.eE]+)", r'{"lon":$1,"lat":$2}',
    )
    nested = F.translate(points, "()", "[]")
    nested = (
        F.when(text.isNull(), None)
        .when(kind == "MULTIPOLYGON", nested)
        .when(kind == "POLYGON", F.concat(F.lit("["), nested, F.lit("]")))
        .otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), text)))
    )
    return F.from_json(nested, POLYGONS, {"mode": "FAILFAST"})


def simplified(df: DataFrame, shape: str, tolerance_m: float) -> Column:
    """The simplified form of ``df[shape]`` as a column, same type."""
    tolerance = float(tolerance_m)

    def simplify(shapes: pa.Array) -> pa.Array:
        return simplify_arrow(shapes, tolerance)

    return F.arrow_udf(simplify, df.schema[shape].dataType)(F.col(shape))


# Executors then need numpy and pyarrow only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
