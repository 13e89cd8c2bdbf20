"""Well-known binary against buffers packed by hand, in both byte orders."""

import random
import struct

import pyarrow as pa
import pytest

from tractwise.functions.wkb import POINT, polygons_from_wkb, read_wkb, wkb_from_polygons, write_wkb
from tractwise.operators import simplify_boundaries, simplify_coverage

SHAPE = pa.list_(pa.list_(pa.list_(POINT)))


def by_hand(polygons, order="<", srid=None, multi=None):
    mark = b"\x01" if order == "<" else b"\x00"

    def polygon(rings):
        out = mark + struct.pack(order + "II", 3, len(rings))
        for ring in rings:
            out += struct.pack(order + "I", len(ring)) + b"".join(struct.pack(order + "dd", *p) for p in ring)
        return out

    if len(polygons) == 1 and not multi:
        out = polygon(polygons[0])
    else:
        out = mark + struct.pack(order + "II", 6, len(polygons)) + b"".join(map(polygon, polygons))
    if srid is not None:
        code = struct.unpack(order + "I", out[1:5])[0] | 0x20000000
        out = mark + struct.pack(order + "II", code, srid) + out[5:]
    return out


def shapes(seed, n):
    rng = random.Random(seed)
    ring = lambda: [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(rng.choice([0, 1, 4, 9]))]
    return [[[ring() for _ in range(rng.choice([0, 1, 1, 3]))] for _ in range(rng.choice([0, 1, 1, 1, 4]))] for _ in range(n)]


def plain(array):
    return [s and [[[(p["lon"], p["lat"]) for p in r] for r in g] for g in s] for s in array.to_pylist()]


def test_reads_both_orders_mixed_in_one_batch():
    given = shapes(1, 200)
    rng = random.Random(2)
    buffers = [by_hand(s, rng.choice("<>"), rng.choice([None, 4326]), rng.random() < 0.5) for s in given]
    buffers[7:7], given[7:7] = [None], [None]
    assert plain(read_wkb(pa.array(buffers, pa.binary()))) == given
    part = pa.array(buffers, pa.binary()).slice(5, 50)
    assert plain(read_wkb(part)) == given[5:55]
    assert read_wkb(pa.array([], pa.binary())).to_pylist() == [] and read_wkb(pa.array([None], pa.binary())).to_pylist() == [None]


@pytest.mark.parametrize("big", [False, True])
def test_writes_what_is_packed_by_hand(big):
    given = shapes(3, 150)
    given[3] = None
    as_structs = [s and [[[{"lon": x, "lat": y} for x, y in r] for r in g] for g in s] for s in given]
    out = write_wkb(pa.array(as_structs, SHAPE), big).to_pylist()
    assert out == [None if s is None else by_hand(s, ">" if big else "<") for s in given]
    assert write_wkb(pa.array([], SHAPE)).to_pylist() == []
    assert plain(read_wkb(write_wkb(pa.array(as_structs, SHAPE).slice(2, 30)))) == given[2:32]


@pytest.mark.parametrize("bad", [
    b"", b"\x01", b"\x07\x03\x00\x00\x00\x00\x00\x00\x00", by_hand([[[(1, 2)]]])[:-1], by_hand([[[(1, 2)]]]) + b"x",
    b"\x01" + struct.pack("<Idd", 1, 1.0, 2.0), b"\x01" + struct.pack("<II", 1003, 0)])
def test_other_buffers_fail(bad):
    with pytest.raises(ValueError):
        read_wkb(pa.array([by_hand([]), bad], pa.binary()))


def test_binary_text_and_arrays_simplify_alike(spark):
    square = [(0.0, 40.0), (0.5, 40.001), (1.0, 40.0), (1.0, 41.0), (0.0, 41.0), (0.0, 40.0)]
    text = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in square) + "))"
    rows = [("a", by_hand([[square]]), text), ("b", by_hand([[square]], ">", 4326, True), text), ("c", None, None)]
    df = spark.createDataFrame(rows, "name string, wkb binary, wkt string").repartition(2)
    for simplify in (simplify_boundaries, simplify_coverage):
        binary = {r.name: r.wkb for r in simplify(df, "wkb").collect()}
        words = {r.name: r.shape for r in simplify(df, "wkt", output="shape").collect()}
        assert binary == words and len(binary["a"][0][0]) == 5 and binary["c"] is None
    back = df.select("name", "wkb", wkb_from_polygons(polygons_from_wkb("wkb")).alias("again")).collect()
    assert [bytes(r.again) for r in back if r.name == "a"] == [by_hand([[square]])]
