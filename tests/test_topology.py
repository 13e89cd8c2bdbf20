"""Shared borders: neighbours keep the same vertices, whatever the direction, start and nesting of their lines."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractwise.functions import topology
from tractwise.operators import simplify_boundaries, simplify_coverage

RING = "array<struct<lon: double, lat: double>>"
N = 5


def edge(x, y, across, rng_seed=0):
    """Vertices from grid node (x, y) to its right (across) or upper neighbour: a wiggle of its own."""
    rng = random.Random(f"{x},{y},{across},{rng_seed}")
    bend = rng.choice([-0.03, 0.0, 0.03])
    out = []
    for j in range(9):
        along, away = j / 8 * 0.125, bend * (1 - abs(j - 4) / 4) + (rng.uniform(-2e-4, 2e-4) if j % 8 else 0)
        out.append((0.125 * x + along, 0.125 * y + away) if across else (0.125 * x + away, 0.125 * y + along))
    return out


def cell(x, y):
    ring = edge(x, y, True)[:-1] + edge(x + 1, y, False)[:-1]
    ring += edge(x, y + 1, True)[:0:-1] + edge(x, y, False)[:0:-1]
    return ring


def closed(ring, seed):
    """The ring from another vertex on, perhaps the other way round, and closed."""
    rng = random.Random(seed)
    at = rng.randrange(len(ring))
    ring = ring[at:] + ring[:at]
    ring = ring[::-1] if rng.random() < 0.5 else ring
    return [*ring, ring[0]]


def grid():
    return [(f"{x}-{y}", closed(cell(x, y), x * 100 + y)) for x in range(N) for y in range(N)]


def sides(ring):
    return {frozenset(s) for s in zip(ring, ring[1:])}


def as_rings(rows):
    return {r.name: [(p.lon, p.lat) for p in r.outline] for r in rows}


def test_neighbours_share_all_sides_of_their_border(spark):
    shapes = spark.createDataFrame(grid(), f"name string, outline {RING}").repartition(4)
    simple = as_rings(simplify_coverage(shapes, "outline").collect())
    before = dict(grid())
    uses = defaultdict(int)
    for name, ring in simple.items():
        assert ring[0] == ring[-1] and set(ring) <= set(before[name]) and 5 <= len(ring) <= 11
        for side in sides(ring):
            uses[side] += 1
    corners = {(0.125 * x, 0.125 * y) for x in range(N + 1) for y in range(N + 1)}
    assert corners <= {p for ring in simple.values() for p in ring}
    # a side inside the grid belongs to two cells, one on its rim to one
    rim = [s for s, n in uses.items() if n == 1]
    assert set(uses.values()) == {1, 2}
    assert all(any(all(abs(p[k] - at) < 0.04 for p in s) for k in (0, 1) for at in (0, 0.125 * N)) for s in rim)
    alone = as_rings(simplify_boundaries(shapes, "outline").collect())
    assert any(alone[n] != simple[n] for n in simple)


def test_areas_add_up(spark):
    shapes = spark.createDataFrame(grid(), f"name string, outline {RING}")

    def area(ring):
        return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))) / 2

    simple = as_rings(simplify_coverage(shapes, "outline").collect())
    uses = defaultdict(list)
    for ring in simple.values():
        for side in sides(ring):
            uses[side].append(1)
    rim = defaultdict(list)
    for side, n in uses.items():
        if len(n) == 1:
            a, b = side
            rim[a].append(b)
            rim[b].append(a)
    start = at = min(rim)
    outline, last = [start], None
    while True:
        following = next(p for p in rim[at] if p != last)
        outline.append(following)
        last, at = at, following
        if at == start:
            break
    assert sum(map(area, simple.values())) == pytest.approx(area(outline), rel=1e-12)


def circle(n=200, radius=1.0):
    return [(radius * math.cos(2 * math.pi * i / n), 40 + radius * math.sin(2 * math.pi * i / n)) for i in range(n)]


def test_a_hole_and_what_fills_it_have_no_junction_and_stay_equal(spark):
    inner, outer = circle(), circle(300, 2.0)
    rows = [("ring", [[closed(outer, 1), closed(inner, 2)]]), ("filling", [[closed(inner, 3)]]), ("none", None), ("empty", []),
            ("part", [[], [closed(inner, 4)]])]
    shapes = spark.createDataFrame(rows, f"name string, shape array<array<{RING}>>")
    out = {r.name: r.shape for r in simplify_coverage(shapes, "shape", tolerance_m=5000).collect()}
    assert out["none"] is None and out["empty"] == [] and out["part"][0] == []
    hole, filling = ({(p.lon, p.lat) for p in x} for x in (out["ring"][0][1], out["filling"][0][0]))
    assert hole == filling == {(p.lon, p.lat) for p in out["part"][1][0]} and 8 < len(hole) < 100
    assert out["ring"][0][0][0] == out["ring"][0][0][-1]


def test_lines_points_and_text(spark):
    line = [(0.0, 40.0), (0.5, 40.0001), (1.0, 40.0)]
    rows = [("line", line), ("point", [(3.0, 3.0)]), ("two", [(3.0, 3.0), (4.0, 4.0)]), ("nothing", []), ("null", None),
            ("other", [(0.5, 40.0001), (0.5, 41.0)]), ("line", line)]
    shapes = spark.createDataFrame(rows, f"name string, outline {RING}")
    out = defaultdict(list)
    for r in simplify_coverage(shapes, "outline", output="simple").collect():
        out[r.name].append(r.simple and [tuple(p) for p in r.simple])
    # the other line ends on the middle of the first, so that vertex is a junction
    assert out["line"] == [line, line] and out["point"] == [[(3.0, 3.0)]] and out["nothing"] == [[]] and out["null"] == [None]
    alone = simplify_coverage(shapes.where("name = 'line'"), "outline").collect()
    assert [len(r.outline) for r in alone] == [2, 2]
    text = spark.createDataFrame([("a", "POLYGON ((0 40, 1 40, 1 40.5, 1 41, 0 41, 0 40))")], "name string, wkt string")
    polygons = simplify_coverage(text, "wkt", output="shape").first().shape
    assert [tuple(p) for p in polygons[0][0]] == [(0.0, 40.0), (1.0, 40.0), (1.0, 41.0), (0.0, 41.0), (0.0, 40.0)]
    assert simplify_coverage(shapes.where("false"), "outline").count() == 0


def test_a_point_of_very_many_lines_is_one_row_per_task(spark, plan_of):
    spokes = [(str(i), [(0.0, 0.0), (math.cos(i), math.sin(i))]) for i in range(300)]
    shapes = spark.createDataFrame(spokes, f"name string, outline {RING}")
    found = topology.junctions(shapes, "outline")
    marks = [m for r in found.collect() for m in r.marks]
    assert {m.place for m in marks} == {0} and len(marks) == 300
    plan = plan_of(found)
    assert plan.count("partial_min") >= 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_arcs_are_the_same_for_every_ring(monkeypatch):
    monkeypatch.setattr(topology, "CHUNK_VERTICES", 50)
    ring = cell(0, 0)
    marks = {ring[0], ring[8], ring[16], ring[24]}
    kept = set()
    for seed in range(12):
        one = closed(ring, seed)
        lon, lat = (np.array(x) for x in zip(*one))
        own = [np.array([i for i, p in enumerate(one[:-1]) if p in marks])]
        mask = topology.kept_on_borders(lon, lat, np.array([len(one)]), own, 500.0)
        kept.add(frozenset(p for p, k in zip(one[:-1], mask) if k))
    assert len(kept) == 1


def test_outlines_are_made_in_many_tasks_and_never_broadcast(spark, plan_of):
    from checks import registry, shapes

    # one small file of keys, which one task would read
    outlines = shapes.areas(registry.Tables(spark, "/root/testdata/sf0.001"))
    assert outlines.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "BroadcastExchange" not in plan_of(simplify_coverage(outlines, "outline"))
