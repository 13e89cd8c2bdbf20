"""Hard negatives: trees against a full scan, the whole operator against brute force on odd tables."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tractwise.llm import negatives
from tractwise.llm.negatives import Tree, packed_order

SCHEMA = "vec_id bigint, embedding array<float>, label int, block string, ints int, positives string"


@pytest.mark.parametrize("n, width, span", [(0, 4, 9), (1, 3, 9), (31, 5, 80), (300, 2, 2), (1500, 3, 3), (900, 64, 80), (40, 0, 1)])
@pytest.mark.parametrize("leaf, fan", [(1, 2), (4, 3), (128, 16)])
def test_tree_finds_what_a_scan_finds(n, width, span, leaf, fan, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", leaf)
    monkeypatch.setattr(negatives, "FAN", fan)
    rng = np.random.default_rng(n + leaf)
    vectors = rng.integers(-span, span + 1, (n, width)).astype(float)
    ids = rng.permutation(n) + 10
    tree = Tree(vectors, ids)
    assert sorted(tree.ids.tolist()) == sorted(ids.tolist())
    for _ in range(6):
        query = rng.integers(-span, span + 1, width).astype(float)
        scores, skip = vectors @ query, int(ids[0]) if n else None
        search = tree.asked(query)
        for least, most, own in ((-math.inf, math.inf, skip), (0, 10, None), (8, 8, None), (5, 4, None), (100, 20000, None)):
            rows = sorted(((int(s), -int(i)) for s, i in zip(scores, ids) if least <= s <= most and i != own), reverse=True)
            assert search.best(5, least, most, own) == [(s, -i) for s, i in rows[:5]]


def test_boxes_outside_the_window_are_not_read(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 16)
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.integers(100 * c, 100 * c + 5, (64, 2)) for c in range(50)]).astype(float)
    search = Tree(vectors, np.arange(len(vectors))).asked(np.array([1.0, 1.0]))
    assert len(search.best(5, 4000, 4020)) == 5
    assert len(search.scores) <= 8  # of 200 leaves


def test_order_is_a_permutation_in_whole_leaves():
    vectors = np.random.default_rng(2).normal(size=(1000, 3))
    assert sorted(packed_order(vectors, 10).tolist()) == list(range(1000))
    first = packed_order(vectors, 10)[:10]
    assert np.ptp(vectors[first], axis=0).max() < np.ptp(vectors, axis=0).max()


def brute(rows, every=100, k=5, m=5):
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(float(np.float32(x)) * 256) for x in v])
        best[i] = min(best.get(i, row), row)
    width = max((len(v) for _, v in best.values()), default=0)
    vectors = {i: np.array(v + [0] * (width - len(v)), dtype=object) for i, (_, v) in best.items()}
    out = set()
    for a in [i for i in best if i % every == 0]:
        scores = sorted(((-int(vectors[a].dot(vectors[i])) if width else 0, i) for i in best if i != a))
        for s, p in [x for x in scores if best[x[1]][0] == best[a][0]][:k]:
            fit = [x for x in scores if best[x[1]][0] != best[a][0] and -80 * s <= -100 * x[0] <= -100 * s][:m]
            out |= {(a, p, r, n, -s, -t) for r, (t, n) in enumerate(fit, 1)}
    return out


def table():
    rng = np.random.default_rng(5)
    base = rng.normal(0.3, 0.4, (60, 4)).round(2)
    rows = [(i, base[i % 60 if i % 3 else i % 7].tolist(), int(i % 4)) for i in range(0, 900, 5)]
    rows += [(100 * i, base[3].tolist(), 1) for i in range(3, 30)]  # many equal vectors, ids repeated
    rows += [(7, None, 1), (100, base[1].tolist(), None), (None, base[2].tolist(), 1), (11, [0.1, None, 0.2, 0.3], 1),
             (12, [0.1, float("nan"), 0.2, 0.3], 1), (13, [float("inf"), 0.1, 0.2, 0.3], 1), (9001, [], 2), (9002, [0.9], 3),
             (9100, [], 0), (9200, [-0.5, -0.5, 0.1, 0.0], 2)]
    return rows


def result(df):
    return {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()}


@pytest.mark.parametrize("block, anchors", [(8192, 1024), (16, 4)])
def test_against_brute_force(spark, block, anchors, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    rows = table()
    vectors = spark.createDataFrame([(*r, "b", 3, "p") for r in rows], SCHEMA).repartition(3)
    found = negatives.hard_negatives(vectors)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute(rows)
    assert len(expected) > 50 and result(found) == expected
    assert found.count() == len(expected)


def test_nothing_and_little(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(nothing).count() == 0
    alone = spark.createDataFrame([(100, [0.5, 0.5], 1, "", 0, "")], SCHEMA)
    assert negatives.hard_negatives(alone).count() == 0
    rows = [(100, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.48], 2)]
    few = spark.createDataFrame([(*r, "", 0, "") for r in rows], SCHEMA)
    assert result(negatives.hard_negatives(few)) == brute(rows) != set()


def test_tiles_hold_few_rows_whatever_the_values(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 50)
    rng = np.random.default_rng(8)
    spread = [(i, [int(x) for x in rng.integers(-99, 99, 3)], 1) for i in range(1000)]
    equal = [(i, [5, 5, i], 2) for i in range(1000, 1600)]
    rows = spark.createDataFrame([(i, label, v) for i, v, label in spread + equal], "vec_id bigint, label bigint, ints array<bigint>")
    tiles = defaultdict(list)
    for r in negatives._tile(rows, negatives.Stored(spark)).collect():
        tiles[r.block].append(r)
    assert sum(map(len, tiles.values())) == 1600 and max(map(len, tiles.values())) <= 100
    assert all(len({r.label for r in t}) == 1 for t in tiles.values())
    own = [t for t in tiles.values() if t[0].label == 1]
    assert np.mean([np.ptp([r.ints[0] for r in t]) for t in own]) < 80  # near in space
