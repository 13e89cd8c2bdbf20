"""Online packing: token round trip, placement against a plain search, no padding, odd tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tractwise.llm import sumsquares, tokens
from tractwise.llm.sumsquares import Levels, placed

SCHEMA = "doc_id bigint, text string, sequence_id string, ids int, length double"


def stream(lengths):
    return ((i, np.arange(n, dtype=np.uint32)) for i, n in enumerate(lengths))


def whole(windows, lengths, size):
    """Each id once and in order, every window full or a power of two."""
    found = Counter()
    for window in windows:
        fill = sum(len(p.ids) for p in window)
        assert 0 < fill <= size and (fill == size or fill & (fill - 1) == 0)
        for p in window:
            assert len(p.ids) and p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
            assert p.total == lengths[p.doc]
            found[p.doc] += len(p.ids)
    return found == Counter(dict(enumerate(lengths)))


@pytest.mark.parametrize("size", [1, 2, 8, 13, 64, 2048])
@pytest.mark.parametrize("n", [0, 1, 3, 400])
def test_every_id_once_without_padding(size, n, monkeypatch):
    rng = random.Random(size + n)
    lengths = [rng.randint(1, 3 * size) for _ in range(n)]
    assert whole(list(placed(stream(lengths), Levels(size))), lengths, size)
    monkeypatch.setattr(sumsquares, "OPEN", 5)  # settled again and again
    assert whole(list(placed(stream(lengths), Levels(size))), lengths, size)


def test_placement_is_the_least_sum_of_squares():
    rng = random.Random(4)
    size, levels, counts = 64, Levels(64), Counter()

    def squares(c):
        return sum(n * n for level, n in c.items() if level & (level - 1) and level < size)

    for _ in range(2000):
        n = rng.choice([rng.randint(1, 63), 20, 44])
        options = []
        for level in [0, *[x for x in range(1, size - n + 1) if counts[x] > 0]]:
            after = Counter(counts)
            after[level] -= level > 0
            after[level + n] += 1
            options.append((squares(after), -level))
        chosen = levels.best(n)
        assert (min(options)) == (next(o for o in options if o[1] == -chosen))
        window = levels.take(chosen) if chosen else []
        counts[chosen] -= chosen > 0
        if chosen + n < size:
            levels.put(chosen + n, window)
            counts[chosen + n] += 1
    assert {level: len(w) for level, w in enumerate(levels.open) if w} == {k: v for k, v in counts.items() if v > 0}


def test_few_documents_are_cut():
    rng = random.Random(7)
    lengths = [int(rng.lognormvariate(6, 1)) + 1 for _ in range(8000)]
    windows = list(placed(stream(lengths), Levels(2048)))
    cuts = sum(map(len, windows)) - sum(-(-n // 2048) for n in lengths)
    assert len(windows) <= sum(lengths) / 2048 + 16 and cuts <= 0.05 * len(lengths)


def texts():
    rng = random.Random(2)
    words = ["a", "word", "tab\tbed", "x\n\ny", "don't", "no break", "é", "世界", "12.5", "<|endoftext|>", " ", "\n", "  "]
    mixed = ["".join(rng.choices(words, k=12)) for _ in range(300)]
    return ["", None, " ", " \n\t", "a  b", " lead", "end ", "w " * 100_000, "q" * 60_000, " " * 60_000 + "z", *mixed]


def test_ids_are_those_of_the_tokenizer():
    vocabulary = tokens.vocabulary(tokens.default_tokenizer())
    assert vocabulary.fast is not None
    ids, begin = vocabulary(pa.array(texts()), 1)
    expected = vocabulary.whole([t or "" for t in texts()])
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [[*e.tolist(), 1] for e in expected]
    fast, vocabulary.fast = vocabulary.fast, None  # as for any other vocabulary
    try:
        again, ends = vocabulary(pa.array(texts()), 1)
        assert again.tolist() == ids.tolist() and ends.tolist() == begin.tolist()
    finally:
        vocabulary.fast = fast


def test_slices_are_whole_and_bounded():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 9, 100, 1, 1)] + [None]})
    parts = [p.column("text").to_pylist() for p in tokens.slices(batch, "text", 10)]
    assert sum(parts, []) == batch.column("text").to_pylist()
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 10 for p in parts)


def test_round_trip_through_spark(spark):
    rows = [(i % 297 if i != 5 else None, t, "s", 1, 2.0) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    packed = sumsquares.pack_online(docs, keep_ids=True).cache()
    encode = tokens.vocabulary(tokens.default_tokenizer())
    expected = Counter((r[0], tuple([*ids.tolist(), 1])) for r, ids in zip(rows, encode.whole([t or "" for t in texts()])))
    held, windows = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        held[r.doc_id, r.doc_tokens].append((r.start, ids))
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at < 2048 and at & (at - 1) == 0
    for (doc, n), parts in held.items():  # rows under one id, or none, may have equal lengths
        copies = [k for k, c in expected.items() for _ in range(c) if k[0] == doc and len(k[1]) == n]
        assert sum(len(ids) for _, ids in parts) == n * len(copies)
        if len(copies) == 1:
            assert sum((ids for _, ids in sorted(parts)), []) == list(copies[0][1])
    assert sum(n for _, n in ((k, c) for k, c in expected.items())) == len(rows)
    whole_windows = sumsquares.sequences(packed).collect()
    assert len(whole_windows) == len(windows)
    assert all(len(r.ids) == 4 * sum(p.length for p in r.parts) for r in whole_windows)
    assert sumsquares.pack_online(docs.where("false")).count() == 0
    assert sumsquares.pack_online(docs).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
