"""The corpus pipeline on small odd tables: each stage against plain Python, and the whole run."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size int"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(400)}" for _ in range(n))


def rows():
    """Good texts with line feeds, copies, near copies, shared lines, bad texts, and odd ones."""
    out = [(i, "\n".join(words(100 * i + k, 30) for k in range(4)), "en", f"s{i % 3}") for i in range(60)]
    shared = words(7, 25)
    out += [(100 + i, words(5000 + i, 70) + "\n" + shared, "en", "s0") for i in range(6)]
    copy = words(9, 150)
    out += [(200 + i, copy, "en", "s1") for i in range(4)]
    near = copy.split()
    out += [(300, " ".join([*near[:70], "other", *near[71:]]), "en", "s1")]
    out += [(400, "too short", "en", "s2"), (401, "again and again " * 60, "en", "s2"), (402, None, "en", "s2"), (403, "", None, None)]
    out += [(1, "short text under a used id", "en", "s1"), (None, words(11, 90), "en", "s0"), (None, "short", "en", "s0")]
    out += [(500, words(12, 100_000), "en", "s1"), (501, words(13, 60), None, None), (501, words(13, 60), None, None)]
    return [(i, t, lang, s, len(t or ""), True, 3) for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def plain(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def enough(text):
    own = (text or "").split()
    seen = Counter(tuple(own[i:i + 3]) for i in range(len(own) - 2))
    repeated = {i + k for i in range(len(own) - 2) if seen[tuple(own[i:i + 3])] > 1 for k in range(3)}
    return len(own) >= 50 and 100 * len(repeated) <= 50 * len(own)


def test_quality_judges_each_row(spark, docs):
    kept = pipeline.quality_rules(spark, docs, "")
    assert kept.columns == docs.columns
    passing = Counter((i, t) for i, t, *_ in rows() if enough(t))
    found = plain(kept)
    assert not found - passing  # nothing that the base rules reject
    assert sum(found.values()) >= 0.95 * sum(passing.values())  # clean ones stay
    assert (1, rows()[1][1]) in found and (1, "short text under a used id") not in found
    assert any(i is None for i, _ in found) and found[501, words(13, 60)] == 2


def test_lines_kept_elsewhere_go(spark, docs):
    cleaned = pipeline.line_dedup(spark, docs, "")
    assert cleaned.columns == docs.columns
    shared, copy = words(7, 25), words(9, 150)
    found = {r.doc_id: r for r in cleaned.collect() if r.doc_id is not None}
    assert shared in found[100].text and all(found[i].text == words(5000 + i - 100, 70) for i in range(101, 106))
    assert found[200].text == copy and not {201, 202, 203, 300} & set(found)
    assert found[101].n_chars == len(found[101].text) and found[3].text == rows()[3][1]
    assert found[402].text is None and found[403].text == "" and len(found[500].text.split()) == 100_000
    assert sum(r.doc_id is None for r in cleaned.collect()) == 2


def test_one_document_of_each_group_stays(spark, docs):
    kept = pipeline.near_dedup(spark, docs, "")
    sets = {}
    for i, t, *_ in rows():
        own = (t or "").lower().split()
        sets.setdefault(i, set()).update(tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4)) if own)
    found = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and not {201, 202, 203, 300} & found
    gone = {i for i in sets if i is not None} - found
    for i in gone:  # each is near one that stays, or near one that is
        assert any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in sets if j != i and j is not None)
    assert None in found and {402, 403, 500, 501} <= found


def test_sources_come_as_often_as_their_rate(spark, docs):
    mixed = pipeline.mix_sources(spark, docs, "")
    before, after = Counter((i, t, s) for i, t, _, s, *_ in rows()), Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    assert mixed.columns == docs.columns and not set(after) - set(before)
    copies = defaultdict(set)
    for key, n in before.items():
        copies[key[2]].add(after[key] / n)
    assert all(max(c) - min(c) <= 1 and max(c) <= 3 for c in copies.values())  # floor of the rate, or one more
    assert plain(pipeline.mix_sources(spark, docs, "")) == plain(mixed)


def test_every_token_is_packed_once(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    packed = pipeline.pack_sequences(spark, docs, "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for i, t, *_ in rows():
        expected[i] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    found, windows = Counter(), defaultdict(list)
    for r in packed:
        found[r.doc_id] += r.length
        windows[r.sequence_id].append((r.offset, r.length))
    assert found == expected
    for parts in windows.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_equals_its_stages(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    packed = pipeline.run(spark, str(tmp_path)).collect()
    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "packing"]
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, kept, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        kept = spark.read.parquet(str(tmp_path / f"stage{k}"))
    again = pipeline.STAGES[-1][1](spark, kept, "").collect()
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert pieces == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in again) and len(pieces) > 60
    assert not {400, 401, 402, 403} & {r.doc_id for r in packed} and 500 in {r.doc_id for r in packed}


def test_an_empty_table_runs_through(spark, docs, tmp_path):
    docs.where("false").write.parquet(os.path.join(tmp_path, "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
