"""Conversation repair: the search against all edit sequences, segments against whole conversations, odd tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tractwise.llm import repair
from tractwise.llm.repair import Resolved, Survivors, edited, joined, transfer

SCHEMA = "conv_id bigint, turn bigint, role string, text string, seg string, cost int, edits double"
NEXT, WANTED = (2, 2, 3, 2), ("", "s", "u", "a")


def every_sequence(rows):
    """The least (cost, edits) by trying all edits: rows are (initial, fault)."""
    best = [10**9, "~"]

    def go(i, state, cost, edits, inserts):
        if cost > best[0]:
            return
        if i == len(rows):
            if state in (0, 3):
                best[:] = min(best, [cost, edits])
        else:
            initial, fault = rows[i]
            go(i + 1, state, cost + 4, edits + "D", 0)
            if fault < 2:
                after = NEXT[state]
                if state == 0 and initial == "s":
                    go(i + 1, 1, cost + 3 * fault, edits + "K", 0)
                if initial == WANTED[after]:
                    go(i + 1, after, cost + 3 * fault, edits + "K", 0)
                go(i + 1, after, cost + 3 + 3 * fault, edits + "R", 0)
        if inserts < 3:
            go(i, NEXT[state], cost + 3, edits + "I", inserts + 1)

    go(0, 0, 0, "", 0)
    return tuple(best)


def plain(rows):
    """The same by a table of whole strings, row by row."""
    def inserted(ways):
        for a, b in ((0, 2), (1, 2), (3, 2), (2, 3)):
            if a in ways:
                ways[b] = min(ways.get(b, (10**9, "~")), (ways[a][0] + 3, ways[a][1] + "I"))
        return ways

    ways = inserted({0: (0, "")})
    for initial, fault in rows:
        new = {}
        for state, (cost, edits) in ways.items():
            options = [(state, cost + 4, "D")]
            if fault < 2:
                after = NEXT[state]
                options += [(1, cost + 3 * fault, "K")] * (state == 0 and initial == "s")
                kept = initial == WANTED[after]
                options.append((after, cost + 3 * fault + 3 * (not kept), "K" if kept else "R"))
            for b, c, edit in options:
                new[b] = min(new.get(b, (10**9, "~")), (c, edits + edit))
        ways = inserted(new)
    return min(ways[x] for x in (0, 3) if x in ways)


def rows_of(rng, n):
    return [(rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_plain_table_equals_all_sequences():
    rng = random.Random(1)
    for _ in range(300):
        rows = rows_of(rng, rng.randint(0, 5))
        assert plain(rows) == every_sequence(rows)


def test_segments_equal_the_whole():
    rng = random.Random(2)
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "": ""}
    for _ in range(800):
        rows = [(*r, rng.choice([1, 1, 1, 1, 2, 4])) for r in rows_of(rng, rng.randint(1, 40))]
        parts, at = [], 0
        while at < len(rows):
            n = rng.randint(1, 9)
            parts.append({**transfer(rows[at: at + n], at == 0 and rng.random() < 0.5), "rows": rows[at: at + n]})
            at += n
        done = list(joined(iter(parts)))
        single = [(i, f if k == 0 else max(f, 2)) for i, f, n in rows for k in range(n)]
        assert (done[-1][3], "".join(d[2] for d in done)) == plain(single)
        assert [d[0]["rows"] for d in done] == [p["rows"] for p in parts] and all(d[3] is None for d in done[:-1])
        left = [r for part, state, edits, _ in done for r in edited(
            edits, state, [names[i] for i, _, _ in part["rows"]], ["t"] * len(part["rows"]), [n for _, _, n in part["rows"]])]
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in left))


@pytest.mark.parametrize("kind", ["alternating", "random", "blank", "one role", "system"])
def test_what_is_undecided_stays_small(kind):
    rng = random.Random(3)
    rows = {
        "alternating": [("ua"[i % 2], 0) for i in range(3000)], "random": [(rng.choice("ua"), 0) for _ in range(3000)],
        "blank": [("u", 3)] * 3000, "one role": [("u", 0)] * 3000, "system": [("s", 0)] * 3000}[kind]
    done = Resolved()
    search, most = Survivors({0: 0}, done), 0
    search.inserts()
    for row in rows:
        search.row(*row)
        most = max(most, *[len(search.way(n)) for n in search.nodes if n is not None])
    if kind in ("one role", "system"):  # whether a first row goes is open to the end, and all edits after it with that
        assert most >= 2900 and len(plain(rows)[1]) == 3000
    else:
        assert most <= 64 and len(done.text()) >= 2900


def expected(table):
    """The report of damaged conversations, by plain Python."""
    seen, rows = {c for c, *_ in table}, defaultdict(list)
    for conv, turn, role, text in table:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in seen:
        own = sorted(rows[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, earlier = [], set()
        for _, role, text in own:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append(3 if not shown else 2 if (role, text) in earlier else 1 if shown[-1] not in ".!?" else 0)
            earlier.add((role, text))
        turns = [t for t, *_ in own if t is not None]
        cost, edits = plain([(r[1][:1], f) for r, f in zip(own, faults)])
        text = "\n".join(f"{role}:{body}" for _, role, body in edited(
            edits, 0, [r[1] for r in own], [r[2] for r in own], [1] * len(own)))
        pairs = zip(own, own[1:])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(3), faults.count(2), faults.count(1),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, edits,
            hashlib.sha256(text.encode()).hexdigest())
    return out


def table():
    rng = random.Random(9)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    texts = ["Yes.", "No!", "What?", "so", "  ", None, "", "x\x0b.\t", "end. no\n", "Ünï。", "a b."]
    rows = [(c, t, "system" if t == 0 and c % 3 == 0 else "user" if t % 2 else "assistant", f"line {c} {t}" + rng.choice([".", "!", ""]))
            for c in range(30) for t in range(rng.randint(1, 12))]
    rows += [(100 + c, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for c in range(20) for _ in range(9)]
    rows += [(None, t, "user", "Hi.") for t in (1, 1, 2, None)] + [(500, t, rng.choice(roles[:4]), f"long {t % 90}.") for t in range(400)]
    rows += [(501, 3, "user", "The same.")] * 300 + [(502, 0, "user", "w. " * 100_000), (502, 1, "assistant", "word " * 50_000)]
    only = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(only, 0, "user", "Dropped.")]


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("rows, partitions", [(64, "4"), (3, "13")])
def test_report_against_plain_python(spark, rows, partitions, monkeypatch):
    monkeypatch.setattr(repair, "ROWS", rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        turns = spark.createDataFrame([(*r, "s", 1, 2.0) for r in table()], SCHEMA).repartition(5)
        report = repair.repair_report(turns)
        assert report.columns == COLUMNS
        found = {r[0]: tuple(r[1:]) for r in report.collect()}
        assert found == expected(table()) and report.count() == len(found)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repaired_turns_alternate_and_keep_texts(spark):
    turns = spark.createDataFrame([(*r, "s", 1, 2.0) for r in table()], SCHEMA)
    fixed, report = repair.repair(turns)
    rows = sorted(repair.repaired_turns(fixed).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.seg, r.place))
    initials = defaultdict(str)
    for r in rows:
        initials[r.conv_id] += r.role[0]
    assert all(re.fullmatch("s?(ua)+", x) for x in initials.values())
    assert {r.text for r in rows if r.edit != "I"} <= {t for *_, t in table()}
    assert {r.conv_id for r in report.collect()} == {c for c, *_ in table()}


def test_no_rows(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(nothing).count() == 0 and repair.repair(nothing)[0].count() == 0
