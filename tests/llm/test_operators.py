"""Operators for training data: small tables with nulls, ties, repeats and clashing names, against brute force."""

import hashlib
import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractwise.llm import chat, lines, lmscore, minhash, mixing, packing, quality, secrets, topk, warc
from tractwise.llm.graph import components
from tractwise.llm.tables import Stored

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, component string, n int"


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    long = sentence(1, 120)
    words = long.split()
    near = " ".join([*words[:60], "other", *words[61:]])
    far = " ".join(x if i % 9 else "new" for i, x in enumerate(words))
    texts = [
        (1, long), (2, near), (3, far), (4, long.upper()), (5, ""), (6, None), (7, "a b"), (8, "A  b"),
        (9, sentence(2, 5000)), (10, sentence(3, 80) + "\n" + sentence(4, 30)), (11, sentence(5, 60) + "\n" + sentence(4, 30)),
        (11, sentence(5, 60) + "\n" + sentence(4, 30)), (None, sentence(6, 70)), (12, " \n\t"),
    ]
    rows = [(i, t, None if i == 7 else "en", None if i == 8 else f"s{(i or 0) % 3}", 1, "x", 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty(docs):
    return docs.where("false")


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_components_are_the_smallest_reachable(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(0, i) for i in range(300, 340)]
    found = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "u bigint, v bigint"), Stored(spark)).collect()}
    label = {i: i for e in edges for i in e}
    for _ in range(200):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    linked = {i for u, v in edges if u != v for i in (u, v)}
    assert found == {i: label[i] for i in linked}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_against_all_pairs(docs, percent, monkeypatch):
    for block in (minhash.BLOCK, 600):  # one block a component, and several
        monkeypatch.setattr(minhash, "BLOCK", block)
        for small in (32, 1):  # by pairs, and by leaders
            monkeypatch.setattr(minhash, "PAIRWISE", small)
            found = minhash.near_duplicates(docs, percent=percent).collect()
            sets = {r.doc_id: shingles(r.text) for r in docs.collect() if r.doc_id}
            label = {i: i for i in sets}
            for _ in range(len(sets)):
                for a, b in combinations(sets, 2):
                    both = len(sets[a] & sets[b])
                    if both and 100 * both >= percent * len(sets[a] | sets[b]):
                        label[a] = label[b] = min(label[a], label[b])
            assert len(found) == docs.count()
            for r in found:
                assert r.kept == (r.component_id == r.doc_id if r.doc_id else True)
                assert r.component_id == label.get(r.doc_id) and (not r.doc_id or r.n_shingles == len(sets[r.doc_id]))
    assert minhash.near_duplicates(empty(docs)).count() == 0
    assert minhash.dedup_documents(docs).columns == docs.columns


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    b = np.concatenate([a[:270], rng.integers(0, 2**63, 30).astype(np.uint64)])
    both = minhash.sketches(np.concatenate([a, b]), np.array([0, 300, 600]))
    n = np.array([300])
    assert abs(minhash.jaccard(both[:1], both[1:], n, n)[0] - 270 / 330) < 0.08
    union = minhash.sketches(np.union1d(a, b), np.array([0, 330]))
    assert (union[0] == both.max(axis=0)).all()  # mergeable


def test_mixing_follows_targets_and_repeats(spark, docs):
    plan = mixing.mix_plan(docs)
    got = plan.collect()
    assert len(got) == docs.count() and max(r.mix_copies for r in got) <= 3
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_plan(docs).collect()))
    assert all(r.mix_size == len((r.text or "").split()) for r in got)
    many = spark.createDataFrame([(i, "a b c d", f"s{i % 4}") for i in range(8000)], "doc_id int, text string, source string")
    for r in mixing.mix_plan(many).groupBy("source").agg(
            F.first("mix_target").alias("t"), F.sum(F.col("mix_size") * F.col("mix_copies")).alias("n")).collect():
        assert abs(r.n - r.t) < 0.1 * r.t
    assert mixing.mix(docs).columns == docs.columns and mixing.mix_plan(empty(docs)).count() == 0


def test_packing_round_trip(docs, monkeypatch):
    from tokenizers import Tokenizer
    import public_tokenizers
    import zlib

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = docs.sparkSession.createDataFrame(
        [(50, "a   b \n c <|endoftext|> d", "en", "s", 1, "x", 1), (51, " é  x  ", "en", "s", 1, "x", 1)], SCHEMA)
    rows = docs.unionByName(odd)
    got = packing.pack(rows, keep_ids=True).collect()
    for r in rows.where("doc_id is not null").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        own = sorted({(g.piece, g.start, g.length, g.ids_crc32, bytes(g.ids)) for g in got if g.doc_id == r.doc_id})
        assert np.frombuffer(b"".join(x[4] for x in own), "<u4").tolist() == ids
        assert [x[1] for x in own] == np.cumsum([0, *[x[2] for x in own[:-1]]]).tolist()
        assert all(x[2] == 2048 for x in own[1:]) and all(x[3] == zlib.crc32(x[4]) for x in own)
    at = {}
    for g in sorted(got, key=lambda g: (g.sequence_id, g.offset)):
        assert g.offset == at.get(g.sequence_id, 0)
        at[g.sequence_id] = g.offset + g.length
    assert max(at.values()) <= 2048
    assert packing.sequences(packing.pack(rows, keep_ids=True)).count() == len(at)
    assert packing.pack(empty(docs)).count() == 0


def test_plan_packs_every_length_and_nearly_fills():
    counts = np.bincount(np.random.default_rng(3).integers(1, 2049, 20_000), minlength=2049)
    used = np.zeros_like(counts)
    plan = packing.plan(counts.copy(), 2048)
    for pattern, times in plan:
        assert sum(pattern) <= 2048 and times > 0
        np.add.at(used, np.array(pattern), times)
    assert (used == counts).all()
    assert sum(t for _, t in plan) <= 1.01 * (counts @ np.arange(2049)) / 2048


def test_archives_keep_payloads(spark):
    body = "<html>" + "x" * 200
    rows = [(1, "http://a\r\nb", body, "z"), (2, None, body, "z"), (2, None, body, "z"), (3, "c", None, "z"),
            (4, "d", "short", "z"), (5, "e", "short", "z"), (6, "f", "\r\n\r\nContent-Length: 9\r\né", "z"), (None, "g", body, "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string")
    got = warc.archive_pages(pages).collect()
    assert len(got) == 7 and all(r.sound for r in got)
    for r in got:
        html = next(h for i, _, h, _ in rows if i == r.page_id) or ""
        assert r.payload_digest == hashlib.sha256(html.encode()).hexdigest() and r.payload_bytes == len(html.encode())
        again = r.page_id == 2
        assert (r.record_type, r.refers_to) == (("revisit", 1) if again else ("response", None))
        assert bytes(r.payload) == (b"" if again else html.encode())
    assert warc.archive_pages(pages.where("false")).count() == 0


def test_quality_counts_and_outliers(spark, docs):
    rows = [(i, sentence(i, 100), "en", "a") for i in range(200)]
    rows += [(1000, " ".join(f"{w}###$$$" for w in sentence(7, 100).split()), "en", "a"), (1001, "a b c " * 40, "en", "a")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_rules(table).collect()}
    assert all(got[i].kept for i in range(200)) and not got[1000].kept and not got[1000].base_failed
    assert got[1001].base_failed and got[1001].n_repeat_words == 120
    odd = quality.quality_rules(docs)
    assert odd.count() == docs.count() and odd.where("n_words < 50 and (kept or not base_failed)").count() == 0
    assert quality.quality_rules(empty(docs)).count() == 0


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 300, None, "so"),
            (2, 0, "system", "alone"), (None, None, "ann", "x"), (1, 1, "ann", "hi")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole = {(r.conv_id, r.perspective): r for r in chat.dialogues(chat.rotate_perspectives(turns)).collect()}
    assert set(whole) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    ann = whole[1, "ann"]
    assert [ann.text[m.start:m.end] for m in ann.masks] == ["hi<|im_end|>"] * 2
    assert "user name=bob\n<|im_end|>" in ann.text and ann.text.startswith("<|im_start|>system\nbe kind")
    assert chat.rotate_perspectives(turns.where("false")).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 8], "r") for i in range(300)]
    rows += [(400 + i, [0.25, 0.25, 0.0, 0.0], "same") for i in range(50)] + [(500, [0.0] * 4, "zero")]
    rows += [(650, [], "empty"), (651, [0.5], "short")]
    rows += [(600, None, "n"), (601, [None, 1.0], "n"), (602, [float("nan")] * 4, "n"), (None, [1.0] * 4, "n")]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    ints = {i: np.floor(256 * np.array(v)).astype(int) for i, v, _ in rows if i is not None and i < 600}
    ints |= {650: np.zeros(4, int), 651: np.array([128, 0, 0, 0])}
    got = sorted(topk.top_k(vectors).collect(), key=lambda r: (r.query_id, r["rank"]))
    want = []
    for q in sorted(i for i in ints if i % 50 == 0):
        best = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == want
    assert topk.top_k(vectors.where("false")).count() == 0


def test_fuzzy_lines_keep_one_each(spark, docs):
    base = sentence(20, 60)
    words = base.split()
    close = " ".join([*words[:30], words[30] + "x", *words[31:]])
    rows = [(i, f"{base}\n{sentence(100 + i, 20)}") for i in range(1, 9)] + [(9, close), (10, "too short"), (11, "too short")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    drops = {(r.doc_id, r.pos) for r in lines.duplicate_lines(table).collect()}
    # the near line is found, and equal lines go whatever their length
    assert drops == {(i, 0) for i in (*range(2, 10), 11)}
    cleaned = lines.dedup_lines(docs)
    assert cleaned.columns == [*docs.columns, "dropped_lines"] and cleaned.count() == docs.count()
    assert cleaned.where("doc_id = 1").first().text == docs.where("doc_id = 1").first().text
    assert cleaned.where("doc_id = 4").first().text == ""
    assert lines.dedup_lines(empty(docs)).count() == 0


def test_scores_prefer_texts_like_the_chosen(spark, docs):
    one = [(i, " ".join(random.Random(i).choices("red green blue".split(), k=50)), True) for i in range(40)]
    two = [(i, " ".join(random.Random(i).choices("cat dog cow red".split(), k=50)), False) for i in range(100, 140)]
    odd = [(200, "", None), (201, None, None), (202, "unseen words only", False)]
    table = spark.createDataFrame([*one, *two, *odd], "doc_id bigint, text string, good boolean")
    got = {r.doc_id: r for r in lmscore.cross_entropy_difference(table, chosen_column="good").collect()}
    assert max(got[i].difference for i in range(40)) < min(got[i].difference for i in range(100, 140))
    assert got[200].difference is None and got[201].n_tokens == 0 and got[202].difference is not None
    assert lmscore.cross_entropy_difference(table.where("false"), chosen_column="good").count() == 0


def test_secrets_on_held_out_findings(spark, docs):
    rng = random.Random(4)
    hexes = ["".join(rng.choices("0123456789abcdef", k=24)) for _ in range(300)]
    rows = [(i, f"some words before password={h} and after", "p") for i, h in enumerate(hexes)]
    rows += [(1000 + i, "plain " + "".join(rng.choices("aeioulmnrst", k=20)) + " words", None) for i in range(300)]
    rows += [(2000 + i, "card " + "".join(rng.choices("0123456789", k=16)) + " paid", "p") for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = secrets.candidates(table, frozenset(["password"]))
    label = secrets.known_kind(F.col("candidate"), F.col("before"))
    model = secrets.train(found.where("doc_id % 2 = 0").withColumn("label", label))
    tried = secrets.scan(found.where("doc_id % 2 = 1"), model).collect()
    assert sum(r.is_secret == (r.doc_id < 1000) for r in tried) >= 0.97 * len(tried)
    assert secrets.scan_documents(docs).count() == 0 and secrets.scan_documents(empty(docs)).count() == 0


def test_common_ends_do_not_change_the_edit_distance(spark):
    pairs = [("x y z", "x z"), ("", "a b"), ("a a b", "a b"), ("ab c", "b c"), ("a b", "a b"), ("é a", "a é"),
             ("a b a b", "a b"), ("cc ab cc", "ab"), ("a", "b")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "u int, lu string, lv string")
    cut = lines._without_common_ends(df, ["u"]).toDF("u", "cu", "cv", "by_words")
    wrong = df.join(cut, "u").where((F.levenshtein("lu", "lv") != F.levenshtein("cu", "cv")) | (F.col("by_words") < F.levenshtein("lu", "lv")))
    assert {r.u: r.by_words for r in cut.collect() if r.u in (0, 3, 5, 8)} == {0: None, 3: 1, 5: 2, 8: 1}
    assert cut.count() == len(pairs) and wrong.count() == 0


def blocks_of(hashes):
    """A line's blocks and their sizes, bit by bit."""
    spare = max(0, math.ceil(math.log2(len(hashes) / lines.COUNTED)))
    hashes = sorted(h for h in hashes if (h % 2**64 >> lines.THINNED) % 2**spare == 0)
    parts = [[h for h in hashes if h % 2**64 >> 61 == b] for b in range(lines.BLOCKS)]
    bits = [p for p in range(lines.LONG) if lines.PLACES >> p & 1]
    return [sum(1 << p for p in bits if 2 * sum(h >> p & 1 for h in part) > len(part)) for part in parts], list(map(len, parts))


def test_signatures_are_majorities_at_every_width(spark):
    sizes = [1, 2, 5, 20, 32, 33, 64, 65, 110, 700, 5000]
    words = spark.createDataFrame([(n, k) for n in sizes for k in range(n)], "n bigint, k int")
    hashes = {n: [] for n in sizes}
    for r in words.select("n", F.xxhash64(F.concat(F.lit("w"), "k")).alias("h")).collect():
        hashes[r.n].append(r.h)
    table = spark.createDataFrame(
        [(n, " ".join(f"W{k} \t w{k}" for k in range(n)) + "\r") for n in sizes], "doc_id bigint, text string")
    for r in lines.line_signatures(table, 1).collect():
        blocks, counts = blocks_of(hashes[r.doc_id])
        assert [r[c] for c in lines.PACKED] == [blocks[i] | blocks[i + 1] << 2 for i in range(0, 8, 2)]
        assert [r.counts % 2**64 >> 8 * b & 255 for b in range(8)] == counts and sum(counts) <= 100
    counted = spark.createDataFrame(list(hashes.items()), "n bigint, hashes array<bigint>")
    for width in lines.WIDTHS:
        fits = [n for n in sizes if n < 1 << width]
        got = counted.where(F.col("n").isin(fits)).select("n", lines._majority(F.col("hashes"), F.col("n"), width).alias("sig"))
        want = {n: sum(1 << p for p in range(lines.LONG) if lines.PLACES >> p & 1 and 2 * sum(h >> p & 1 for h in hashes[n]) > n)
                for n in fits}
        assert {r.n: r.sig for r in got.collect()} == want


def test_lines_that_agree_in_enough_blocks_share_a_key(spark):
    words = sentence(21, 60).split()
    table = spark.createDataFrame(
        [(i, " ".join([*words[:i], "zz", *words[i + 1:]])) for i in range(60)] + [(100, "same few"), (101, sentence(5, 60))],
        "doc_id bigint, text string")
    signed = lines.line_signatures(table, 5)
    assert signed.where("doc_id = 100").first().counts is None
    keys = {r.doc_id: set(r[1:]) for r in lines.line_keys(signed, ["doc_id"]).collect()}
    # two lines of the sixty differ in the block of zz and those of the two words it replaces
    assert all(keys[a] & keys[b] for a in range(60) for b in range(60)) and not any(keys[a] & keys[101] for a in range(60))
    assert all(1 <= len(k) <= lines.BLOCKS for k in keys.values())


def test_kept_lines_are_the_first_of_their_groups(spark):
    rng = random.Random(12)
    rows = []
    for d in range(60):
        own = [sentence(rng.randrange(25), 12 + rng.randrange(25) % 3) for _ in range(rng.randrange(4))]
        own += [" ".join(["Short", f"line{rng.randrange(6)}"]), "   ", "one\ttwo  THREE four five" + "\r" * (d % 2)]
        rows.append((d, "\n".join(own)))
    table = spark.createDataFrame(rows + [(7, rows[7][1])], "doc_id bigint, text string")
    found = {(r.doc_id, r.pos): (r.keeper_doc, r.keeper_pos) for r in lines.duplicate_lines(table).collect()}
    places = [(d, pos, " ".join(x.lower().split())) for d, t in rows for pos, x in enumerate(t.split("\n")) if x.split()]
    label = {text: text for *_, text in places}

    def near(a, b):
        if min(len(a.split()), len(b.split())) < 5:
            return False
        return distance(a, b) <= int(max(len(a), len(b)) * 0.1 + 1e-9)

    texts = sorted(label)
    for _ in range(4):
        for a in texts:
            for b in texts:
                if a < b and abs(len(a) - len(b)) < 9 and near(a, b):
                    label[a] = label[b] = min(label[a], label[b])
    first = {}
    for d, pos, text in sorted(places):
        first.setdefault(label[text], (d, pos))
    assert found == {(d, pos): first[label[t]] for d, pos, t in places if first[label[t]] != (d, pos)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def test_similar_lines_are_found_as_brute_force_finds_them(spark):
    rng = random.Random(9)
    texts = []
    for i, n in enumerate([6, 8, 10, 12, 15, 20, 25, 30, 40] * 8):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(10 ** 5):05}" for _ in range(n)]
        changed = list(words)
        for at in rng.sample(range(n), max(1, n // 10)):
            changed[at] = changed[at][:-1] + "x" if n < 10 else f"z{rng.randrange(10 ** 5):05}"
        texts += [" ".join(words), " ".join(changed)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = {i + 1 for i in range(0, len(texts), 2)
            if 10 * distance(texts[i], texts[i + 1]) <= max(len(texts[i]), len(texts[i + 1]))}
    got = {r.doc_id for r in lines.duplicate_lines(table).collect()}
    assert len(want) > 50 and got <= want and len(got) >= 0.95 * len(want)


def test_recall_by_length(spark):
    """Of lines with a changed word in ten or fewer, at least nine in ten are found in each class of lengths."""
    rng = random.Random(31)
    for low, high in ((6, 15), (16, 30), (31, 60), (61, 120)):
        texts = []
        for _ in range(120):
            words = [f"{rng.choice('abcdefgh')}{rng.randrange(10 ** 5):05}" for _ in range(rng.randint(low, high))]
            changed = list(words)
            for at in rng.sample(range(len(words)), rng.randint(1, max(1, min(4, len(words) // 12)))):
                changed[at] = changed[at][:-1] + "x" if len(words) < 11 else f"z{rng.randrange(10 ** 5):05}"
            if rng.random() < 0.3 and len(words) > 20:
                del changed[rng.randrange(len(changed))]
            texts += [" ".join(words), " ".join(changed)]
        want = {i + 1 for i in range(0, len(texts), 2)
                if 10 * distance(texts[i], texts[i + 1]) <= max(len(texts[i]), len(texts[i + 1]))}
        table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        got = {r.doc_id for r in lines.duplicate_lines(table).collect()}
        assert len(want) > 60 and got <= want and len(got) >= 0.9 * len(want), (low, len(got), len(want))


def test_a_common_passage_compares_few_lines(spark):
    passage = sentence(50, 12)
    rows = [(i, f"{sentence(2000 + i, 15)} {passage} {sentence(9000 + i, 15)}") for i in range(1200)]
    table, stored = spark.createDataFrame(rows, "doc_id bigint, text string"), Stored(spark)
    groups = stored(lines.line_signatures(table, 5))
    pairs, members = lines.buckets(groups, stored)
    near = lines._with_signatures(pairs, groups, stored).where(lines._near(0.9))
    none = pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).where("false")
    # of 719,400 pairs
    assert near.count() <= 12 and lines.other_pairs(members, none, groups, 0.9, stored).count() <= 12


def test_scores_equal_brute_force_whatever_is_broadcast(spark):
    rng = random.Random(3)
    texts = [(i, " ".join(f"v{int(rng.expovariate(0.05))}" for _ in range(rng.randrange(1, 60))), i % 4 == 0) for i in range(60)]
    rows = [*texts, texts[4], texts[4], (900, "", True), (901, None, None), (None, "v1 v2 v3", None), (7, "v1 v2 other", False)]
    split = [((t or "").split(), bool(good)) for _, t, good in rows]
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for w, good in split:
        for i in (0, 1) if good else (1,):
            words[i].update(w)
            pairs[i].update(zip(w, w[1:]))
    held = {w for w, n in words[1].items() if n > 1}
    size = words[0].total()
    scale = (1, size / words[1].total())
    unknown = [max(0, size - sum(words[i][w] for w in held) * scale[i]) for i in (0, 1)]

    def loss(w, i):
        def count(x):
            return words[i][x] * scale[i] if x in held else unknown[i]

        out = []
        for at, x in enumerate(w):
            chance = (count(x) + 0.5) / (size + 0.5 * (len(held) + 1))
            if at:
                pair = (w[at - 1], x)
                seen = pairs[i][pair] * scale[i] if pairs[1][pair] > 1 else 0
                chance = (min(seen / count(w[at - 1]), 1) if count(w[at - 1]) else 0) / 2 + chance / 2
            out.append(-np.log(chance))
        return float(np.mean(out))

    want = sorted((i is None, i or 0, len(w), *((loss(w, 0), loss(w, 1)) if w else (0, 0))) for (i, _, _), (w, _) in zip(rows, split))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, good boolean")
    for share in (1e-6, 0.02, 1.0):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.target_loss or 0, r.background_loss or 0)
                     for r in lmscore.cross_entropy_difference(table, chosen_column="good", share=share).collect())
        assert len(got) == len(want) and np.allclose(np.array(got, float), np.array(want, float), atol=1e-9)


def test_a_group_of_variants_takes_few_edit_distances(spark, monkeypatch):
    """Variants that the leaders leave apart are linked by their nearest ones, not all compared with all."""
    rng, base = random.Random(5), [f"w{i:04}" for i in range(60)]
    texts = [" ".join(f"x{rng.randrange(10 ** 4):04}" if rng.random() < 0.08 else w for w in base) for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    compared, similar_lines = [], lines.similar_lines

    def counted(pairs, *rest):
        pairs = pairs.localCheckpoint()
        compared.append(pairs.count())
        return similar_lines(pairs, *rest)

    monkeypatch.setattr(lines, "similar_lines", counted)
    monkeypatch.setattr(lines, "CROWD", 1)
    got = {r.doc_id: r.keeper_doc for r in lines.duplicate_lines(table).collect()}
    monkeypatch.setattr(lines, "CROWD", 10 ** 6)
    first = len(compared)
    assert got == {r.doc_id: r.keeper_doc for r in lines.duplicate_lines(table).collect()} and len(got) > 100
    assert 4 * sum(compared[:first]) < 3 * sum(compared[first:])
