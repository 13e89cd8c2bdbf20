import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tractwise.functions import geometry
from tractwise.functions.geometry import EARTH_RADIUS_M, kept_vertices, simplify_arrow
from tractwise.operators import simplify_boundaries


def metres(lon, lat):
    return (np.radians(lon) * EARTH_RADIUS_M * np.cos(np.radians(np.mean(lat))),
            np.radians(lat) * EARTH_RADIUS_M)


def gap(x, y, a, b, i):
    dx, dy = x[b] - x[a], y[b] - y[a]
    length2 = dx * dx + dy * dy
    u = 0.0 if length2 == 0 else min(1.0, max(0.0, ((x[i] - x[a]) * dx + (y[i] - y[a]) * dy) / length2))
    return float(np.hypot(x[i] - x[a] - u * dx, y[i] - y[a] - u * dy))


def recursive(lon, lat, tolerance):
    """Plain recursive form, one line at a time."""
    x, y = metres(lon, lat)
    kept = {0, len(lon) - 1}

    def split(a, b):
        if b - a < 2:
            return
        gaps = [gap(x, y, a, b, i) for i in range(a + 1, b)]
        far = int(np.argmax(gaps))
        if gaps[far] > tolerance:
            kept.add(a + 1 + far)
            split(a, a + 1 + far)
            split(a + 1 + far, b)

    split(0, len(lon) - 1)
    return kept


point = st.tuples(st.floats(-1, 1, width=32), st.floats(40, 41, width=32))
line = st.lists(point, min_size=1, max_size=25)


@settings(max_examples=60, deadline=None)
@given(st.lists(line, min_size=1, max_size=6), st.sampled_from([10.0, 2100.0, 50000.0]))
def test_simplified_lines_stay_within_tolerance(lines, tolerance):
    lon = np.array([p[0] for points in lines for p in points])
    lat = np.array([p[1] for points in lines for p in points])
    lengths = np.array([len(points) for points in lines])
    keep = kept_vertices(lon, lat, lengths, tolerance)
    start = 0
    for n in lengths:
        ring = slice(start, start + n)
        kept = np.flatnonzero(keep[ring])
        assert kept[0] == 0 and kept[-1] == n - 1
        x, y = metres(lon[ring], lat[ring])
        for a, b in zip(kept[:-1], kept[1:]):
            assert all(gap(x, y, a, b, i) <= tolerance * (1 + 1e-9) + 1e-6 for i in range(a + 1, b))
        start += n


def test_batch_form_equals_recursive_form():
    random = np.random.default_rng(5)
    lines = [np.cumsum(random.normal(0, 0.01, (n, 2)), axis=0) + [10, 50] for n in (1, 2, 3, 40, 400)]
    ring = np.vstack([lines[3], lines[3][:1]])
    lines.append(ring)
    lon, lat = np.concatenate([p[:, 0] for p in lines]), np.concatenate([p[:, 1] for p in lines])
    keep = kept_vertices(lon, lat, np.array([len(p) for p in lines]), 2100.0)
    start = 0
    for p in lines:
        assert set(np.flatnonzero(keep[start:start + len(p)])) == recursive(p[:, 0], p[:, 1], 2100.0)
        start += len(p)


SQUARE = [(0.0, 0.0), (0.5, 0.0001), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
CORNERS = [p for p in SQUARE if p != (0.5, 0.0001)]


def test_operator_on_rings_nulls_and_nested_shapes(spark):
    ring = "array<struct<lon: double, lat: double>>"
    df = spark.createDataFrame(
        [("a", SQUARE), ("b", None), ("c", []), ("d", [(2.0, 2.0)])], f"id string, geom {ring}"
    )
    got = {r.id: r.geom for r in simplify_boundaries(df, "geom").collect()}
    assert [tuple(p) for p in got["a"]] == CORNERS
    assert got["b"] is None and got["c"] == [] and [tuple(p) for p in got["d"]] == [(2.0, 2.0)]
    many = spark.createDataFrame(
        [("a", [[SQUARE, SQUARE], []]), ("b", [[SQUARE]])], f"id string, geom array<array<{ring}>>"
    )
    nested = simplify_boundaries(many, "geom", output="plain")
    assert nested.schema["plain"].dataType == many.schema["geom"].dataType
    shapes = {r.id: [[[tuple(p) for p in r_] for r_ in poly] for poly in r.plain] for r in nested.collect()}
    assert shapes == {"a": [[CORNERS, CORNERS], []], "b": [[CORNERS]]}


def test_chunks_give_the_same_result(monkeypatch):
    shapes = pa.array([[{"lon": x, "lat": y} for x, y in SQUARE]] * 7 + [None, []])
    whole = simplify_arrow(shapes, 2100.0)
    monkeypatch.setattr(geometry, "CHUNK_VERTICES", 8)
    assert simplify_arrow(shapes, 2100.0).equals(whole)
    assert simplify_arrow(pa.array([], type=shapes.type), 1.0).to_pylist() == []


def test_well_known_text(spark):
    ring = "(0 0, 0.5 0.0001, 1 0, 1 1, 0 1, 0 0)"
    df = spark.createDataFrame(
        [("a", f"POLYGON ({ring})"), ("b", f"multipolygon(({ring}, {ring}), ({ring}))"), ("c", None),
         ("d", "POLYGON((-1e-1 2, 3.5 -4, 5 6, -1e-1 2))")],
        "id string, text string",
    )
    got = {
        r.id: r.text and [[[tuple(p) for p in ring_] for ring_ in polygon] for polygon in r.text]
        for r in simplify_boundaries(df, "text").collect()
    }
    assert got["a"] == [[CORNERS]] and got["b"] == [[CORNERS, CORNERS], [CORNERS]] and got["c"] is None
    assert got["d"] == [[[(-0.1, 2.0), (3.5, -4.0), (5.0, 6.0), (-0.1, 2.0)]]]
    with pytest.raises(Exception, match="not a polygon"):
        simplify_boundaries(spark.createDataFrame([("POINT (1 2)",)], "g string"), "g").collect()
