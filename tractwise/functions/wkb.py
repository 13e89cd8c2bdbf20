"""Polygons in well-known binary form, read and written whole batches at a time."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import _parse_datatype_string

from tractwise.functions.geometry import POLYGONS

#: Geometry codes, and the flag of a code that a reference system's number follows.
POLYGON, MULTIPOLYGON, WITH_SRID = 3, 6, 0x20000000
POINT = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])


class _Cursor:
    """A place in each of many buffers, read forward together."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.data, self.at, self.end = data, begin.copy(), end
        self.big = np.zeros(len(begin), bool)

    def take(self, rows: np.ndarray, n: int) -> np.ndarray:
        """``n`` bytes of each of ``rows``, as rows of a matrix."""
        if (self.at[rows] + n > self.end[rows]).any():
            raise ValueError("well-known binary ends too early")
        found = self.data[self.at[rows][:, None] + np.arange(n)]
        self.at[rows] += n
        return found

    def number(self, rows: np.ndarray) -> np.ndarray:
        raw = self.take(rows, 4)
        raw[self.big[rows]] = raw[self.big[rows], ::-1]
        return raw.view("<u4").ravel().astype(np.int64)

    def header(self, rows: np.ndarray) -> np.ndarray:
        """Byte order and geometry code; a reference system's number is passed over."""
        order = self.take(rows, 1).ravel()
        if (order > 1).any():
            raise ValueError("not well-known binary: unknown byte order")
        self.big[rows] = order == 0
        code = self.number(rows)
        self.number(rows[code & WITH_SRID > 0])
        return code & ~WITH_SRID


def read_wkb(shapes: pa.Array) -> pa.Array:
    """Polygons (lists of rings of ``{lon, lat}``) of ``POLYGON`` and ``MULTIPOLYGON`` buffers of either byte order.

    All buffers are read side by side, one header of each at a time, so the steps are as
    many as the longest one has rings; points are then gathered at once. NULL stays NULL.
    Other shapes, further dimensions and buffers that end early fail.
    """
    shapes = shapes.cast(pa.large_binary())
    n, missing = len(shapes), shapes.is_null().to_numpy(zero_copy_only=False)
    _, offsets, content = shapes.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1, shapes.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    cursor = _Cursor(data, ends[:-1], ends[1:])
    rows = np.flatnonzero(~missing)
    code = np.zeros(n, np.int64)
    code[rows] = cursor.header(rows)
    if not np.isin(code[rows], (POLYGON, MULTIPOLYGON)).all():
        raise ValueError("not a polygon")
    polygons, many = np.zeros(n, np.int64), rows[code[rows] == MULTIPOLYGON]
    polygons[rows[code[rows] == POLYGON]] = 1
    polygons[many] = cursor.number(many)
    found_polygons: list[tuple[np.ndarray, np.ndarray]] = []  # row, rings
    found_rings: list[tuple] = []  # row, order of the polygon in its row, points, first byte, big-endian
    left, nth = polygons.copy(), np.zeros(n, np.int64)
    while (rows := np.flatnonzero(left > 0)).size:
        inner = rows[code[rows] == MULTIPOLYGON]
        if inner.size and (cursor.header(inner) != POLYGON).any():
            raise ValueError("not a polygon")
        rings = cursor.number(rows)
        found_polygons.append((rows, nth[rows], rings))
        while (some := rings > 0).any():
            reading = rows[some]
            points = cursor.number(reading)
            found_rings.append((reading, nth[reading], points, cursor.at[reading].copy(), cursor.big[reading].copy()))
            cursor.at[reading] += 16 * points
            if (cursor.at[reading] > cursor.end[reading]).any():
                raise ValueError("well-known binary ends too early")
            rings = rings - some
        left[rows] -= 1
        nth[rows] += 1
    if (cursor.at != cursor.end)[~missing].any():
        raise ValueError("well-known binary goes on after its shape")

    def merged(parts: list[tuple], width: int) -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * width
        order = np.lexsort((np.arange(len(columns[0])), columns[1], columns[0]))  # rounds kept the order within
        return [c[order] for c in columns]

    _, _, rings = merged(found_polygons, 3)
    _, _, points, first, big = merged(found_rings, 5)
    upto = np.cumsum(points)
    place = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - points, points)
    where = np.repeat(first, points) + 16 * place
    raw = data[where[:, None] + np.arange(16)].reshape(-1, 2, 8)
    swap = np.repeat(big.astype(bool), points)
    raw[swap] = raw[swap][:, :, ::-1]
    xy = np.ascontiguousarray(raw).view("<f8").reshape(-1, 2)
    array = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(POINT))
    for sizes in (points, rings):
        array = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), array)
    offsets = pa.array(np.concatenate([[0], np.cumsum(polygons)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, array, mask=pa.array(missing))


def write_wkb(shapes: pa.Array, big_endian: bool = False) -> pa.Array:
    """Buffers of polygons (lists of rings of points): ``POLYGON`` for one, else ``MULTIPOLYGON``."""
    def sizes(array: pa.Array) -> np.ndarray:
        return array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

    def starts(lengths: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(lengths)])

    missing = shapes.is_null()
    polygons = sizes(shapes)
    rings = sizes(shapes := shapes.flatten())
    points = sizes(shapes := shapes.flatten())
    shapes = shapes.flatten()
    whole, number = (">f8", ">u4") if big_endian else ("<f8", "<u4")
    single = polygons == 1
    # bytes of each ring, polygon and shape, and where they begin
    ring_bytes = 4 + 16 * points
    polygon_bytes = 9 + np.add.reduceat(np.append(ring_bytes, 0), starts(rings)[:-1]) * (rings > 0) if len(rings) else rings
    shape_bytes = np.where(single, 0, 9) + (
        np.add.reduceat(np.append(polygon_bytes, 0), starts(polygons)[:-1]) * (polygons > 0) if len(polygons) else polygons)
    shape_bytes[missing.to_numpy(zero_copy_only=False)] = 0
    shape_at = starts(shape_bytes)
    out = np.zeros(shape_at[-1], np.uint8)

    def within(parents: np.ndarray, counts: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Where parts begin: after the parts of the same parent before them."""
        before = starts(own)[:-1]
        first = np.repeat(starts(own)[starts(counts)[:-1]], counts)
        return np.repeat(parents, counts) + before - first

    def put(at: np.ndarray, values: np.ndarray, kind: str) -> None:
        raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), int(kind[-1]))
        out[at[:, None] + np.arange(raw.shape[1])] = raw

    def head(at: np.ndarray, code: int, counts: np.ndarray) -> None:
        out[at] = 0 if big_endian else 1
        put(at + 1, np.full(len(at), code), number)
        put(at + 5, counts, number)

    several = ~single & ~missing.to_numpy(zero_copy_only=False)
    head(shape_at[:-1][several], MULTIPOLYGON, polygons[several])
    polygon_at = within(shape_at[:-1] + np.where(single, 0, 9), polygons, polygon_bytes)
    head(polygon_at, POLYGON, rings)
    ring_at = within(polygon_at + 9, rings, ring_bytes)
    put(ring_at, points, number)
    point_at = within(ring_at + 4, points, np.full(points.sum(), 16))
    for i, name in enumerate(("lon", "lat")):
        put(point_at + 8 * i, shapes.field(name).to_numpy(zero_copy_only=False), whole)
    gone = missing.to_pylist()
    return pa.array(
        [None if g else out[a:b].tobytes() for g, a, b in zip(gone, shape_at, shape_at[1:])], pa.large_binary())


def polygons_from_wkb(shape: Column | str) -> Column:
    """The polygons of a binary column as nested arrays (polygons, rings, points)."""
    return F.arrow_udf(lambda shapes: read_wkb(shapes), _parse_datatype_string(POLYGONS))(shape)


def wkb_from_polygons(shape: Column | str, *, big_endian: bool = False) -> Column:
    """Nested arrays (polygons, rings, points) in binary form."""
    return F.arrow_udf(lambda shapes: write_wkb(shapes, big_endian).cast(pa.binary()), "binary")(shape)


# Executors then need numpy and pyarrow only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
