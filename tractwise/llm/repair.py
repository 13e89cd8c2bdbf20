"""Repairing the structure of conversations: cheapest edits by a Viterbi search whose survivors coalesce."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tractwise.llm.tables import Stored
from tractwise.session import replicated_if_small

#: Different rows and bytes of text that one segment of a conversation holds at most (or one row).
ROWS, BYTES = 64, 64 * 1024
#: What edits cost; a truncated row that stays costs ``REROLE`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of a transcript: nothing yet, after system, after user, after assistant. The first and the last may end it.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state that the next user or assistant row leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = (None, "system", "user", "assistant")
#: Faults of a row.
SOUND, CUT_OFF, REPEATED, BLANK = range(4)


class Node:
    """An edit (or several) on the way to survivors; ``refs`` counts its children and the survivors that stand on it."""

    __slots__ = ("label", "parent", "refs", "note")

    def __init__(self, label: str, parent: Node | None, note=None):
        self.label, self.parent, self.refs, self.note = label, parent, 0, note


class Survivors:
    """The cheapest way to each state, as leaves of one tree of backpointers.

    Of equal ways to a state the one with the ASCII-least edits survives. Ways are compared
    as wholes, but not anew each time: ``apart`` holds, for each two survivors, what is
    left of their unresolved ways without their common begin (once they differ, the first
    edit of each tells). What all survivors have in common is handed to ``emit`` and
    forgotten, so the tree holds what is undecided.
    """

    def __init__(self, costs: dict[int, int], emit: Callable[[str, object], None]):
        self.root, self.emit = Node("", None), emit
        self.costs = [costs.get(state) for state in STATES]
        self.nodes = [None if c is None else self.root for c in self.costs]
        self.root.refs = len(costs)
        self.apart = [[("", "")] * len(STATES) for _ in STATES]

    def way(self, node: Node) -> str:
        labels = []
        while node is not self.root:
            labels.append(node.label)
            node = node.parent
        return "".join(reversed(labels))

    def _release(self, node: Node) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                break
            node = node.parent

    def _differ(self, x: int, one: str, y: int, two: str) -> tuple[str, str]:
        """How the way to state ``x`` with edits ``one`` and that to ``y`` with ``two`` go on where they part."""
        a, b = ("", "") if x == y else self.apart[x][y]
        if a and b:
            return a, b
        a, b = a + one, b + two
        n = len(os.path.commonprefix((a, b)))
        a, b = a[n:], b[n:]
        return (a[0], b[0]) if a and b else (a, b)

    def _least(self, options: list[tuple]) -> tuple | None:
        """Of options (cost, state they come from, label, note) the cheapest, then the least way."""
        best = None
        for o in options:
            if best is None or o[0] < best[0]:
                best = o
            elif o[0] == best[0]:
                a, b = self._differ(o[1], o[2], best[1], best[2])
                best = o if a < b else best
        return best

    def step(self, options: list[list[tuple]]) -> None:
        """All states at once: the survivors are the least of each state's options."""
        chosen = [self._least(o) for o in options]
        new = []
        for o in chosen:
            if o is not None:
                node = Node(o[2], self.nodes[o[1]], o[3])
                node.refs, node.parent.refs = 1, node.parent.refs + 1
            new.append(None if o is None else node)
        self.apart = [[("", "") if o is None or p is None else self._differ(o[1], o[2], p[1], p[2]) for p in chosen]
                      for o in chosen]
        old, self.nodes = self.nodes, new
        self.costs = [None if o is None else o[0] for o in chosen]
        for node in old:
            if node is not None:
                self._release(node)

    def insert(self, state: int) -> None:
        """Lets ``state`` be reached by inserting a row, if that is cheaper or as cheap and less."""
        here = [] if self.costs[state] is None else [(self.costs[state], state, "", None)]
        ways = here + [(self.costs[x] + INSERT, x, "I", None)
                       for x in STATES if NEXT[x] == state and self.costs[x] is not None]
        best = self._least(ways)
        if best is not None and best[1] != state:
            node, old = Node("I", self.nodes[best[1]]), self.nodes[state]
            node.refs, node.parent.refs = 1, node.parent.refs + 1
            row = [self._differ(best[1], "I", y, "") for y in STATES]
            self.apart[state] = row
            for y in STATES:
                self.apart[y][state] = row[y][::-1]
            self.apart[state][state] = ("", "")
            self.nodes[state], self.costs[state] = node, best[0]
            if old is not None:
                self._release(old)

    def coalesce(self) -> None:
        """Emits the edits that all survivors share."""
        while self.root.refs == 1 and not any(n is self.root for n in self.nodes):
            path, node = [], next(n for n in self.nodes if n is not None)
            while node is not self.root:
                path.append(node)
                node = node.parent
            for node in reversed(path):
                self.emit(node.label, node.note)
                node.parent, self.root = None, node
                if node.refs != 1 or any(n is node for n in self.nodes):
                    return

    def row(self, initial: str, fault: int, copies: int = 1) -> None:
        """One row of a conversation, and ``copies`` - 1 repetitions of it, which must all go."""
        costs, must_go = self.costs, fault in (BLANK, REPEATED)
        options = [[] if c is None else [(c + DELETE, x, "D", None)] for x, c in enumerate(costs)]
        if not must_go:
            extra = TRUNCATED * (fault == CUT_OFF)
            for x, c in enumerate(costs):
                if c is None:
                    continue
                if x == START and initial == "s":
                    options[SYSTEM].append((c + extra, x, "K", None))
                kept = initial == ROLE[NEXT[x]][0]
                options[NEXT[x]].append((c + extra + (0 if kept else REROLE), x, "K" if kept else "R", None))
        self.step(options)
        self.inserts()
        if copies > 1:  # an insertion comes after all of them, as D is less than I
            n = copies - 1
            self.step([[] if c is None else [(c + DELETE * n, x, "D" * n, None)] for x, c in enumerate(self.costs)])
            self.inserts()
        self.coalesce()

    def inserts(self) -> None:
        """Insertions after a row; then states that cannot win any more go, or no way would ever be decided.

        What follows can follow the assistant too, but for keeping a system row: from the
        start, instead of deleting it (``DELETE``). So a way that costs more than that
        beyond the assistant's loses strictly, whatever comes.
        """
        self.insert(USER)
        self.insert(ASSISTANT)
        for state, ahead in ((START, DELETE), (SYSTEM, 0)):
            if self.costs[state] is not None and self.costs[state] > self.costs[ASSISTANT] + ahead:
                self._release(self.nodes[state])
                self.costs[state] = self.nodes[state] = None


class Resolved(list):
    """Collects what survivors emit, with the notes of each."""

    def __call__(self, label: str, note) -> None:
        self.append((label, note))

    def text(self) -> str:
        return "".join(label for label, _ in self)


def transfer(rows: list[tuple[str, int, int]], fresh: bool = False) -> dict:
    """What a segment (initial, fault and copies of each row) does to any state before it.

    ``costs`` holds 16 costs, from state a to state b at 4 * a + b (NULL: impossible); the
    edits from a to b are ``heads[a] + middle + tails[4 * a + b]``. However the segment is
    entered, the edits are soon the same ones, so most of them are in ``middle``, once.
    A ``fresh`` segment begins its conversation: it has the four costs from the start alone.
    """
    costs, trunks, tails = [], [], []
    for a in (START,) if fresh else STATES:
        trunk = Resolved()
        search = Survivors({a: 0}, trunk)
        if fresh:
            search.inserts()
        for row in rows:
            search.row(*row)
        trunks.append(trunk.text())
        costs += search.costs
        tails += [None if n is None else search.way(n) for n in search.nodes]
    middle = os.path.commonprefix([t[::-1] for t in trunks])[::-1]
    return {"costs": costs, "heads": [t[: len(t) - len(middle)] for t in trunks], "middle": middle, "tails": tails}


def joined(segments: Iterator[dict]) -> Iterator[tuple[dict, int, str, int | None]]:
    """The segments of one conversation in order, each with the state it is entered in, its edits and, at the last, the cost.

    A search like the one over rows, with a segment for a row: it holds the segments that
    are undecided. Rows may be inserted before the first one.
    """
    ready = Resolved()
    search, first = Survivors({START: 0}, ready), True
    for segment in segments:
        entered = [(a, cost, "") for a, cost in enumerate(search.costs) if cost is not None]
        if first and len(segment["costs"]) > len(STATES):
            entered += [(USER, INSERT, "I"), (ASSISTANT, 2 * INSERT, "II")]
        options: list[list[tuple]] = [[] for _ in STATES]
        for a, cost, edits in entered:
            for b in STATES:
                own = segment["costs"][4 * a + b]
                if own is not None:
                    label = edits + segment["heads"][a] + segment["middle"] + segment["tails"][4 * a + b]
                    options[b].append((cost + own, START if first else a, label, (segment, START if first else a)))
        search.step(options)
        search.coalesce()
        first = False
        # the last segment waits for the end, which decides between its ways
        while len(ready) > 1:
            label, (done, state) = ready.pop(0)
            yield done, state, label, None
    ends = [(search.costs[x], x, "", None) for x in (START, ASSISTANT) if search.costs[x] is not None]
    cost, state, _, _ = search._least(ends)
    search.step([[(cost, state, "", None)] if x == state else [] for x in STATES])
    search.coalesce()
    rest = [x for x in ready if x[1] is not None]
    for i, (label, (done, state)) in enumerate(rest):
        yield done, state, label, cost if i == len(rest) - 1 else None


def edited(edits: str, state: int, roles: list[str], texts: list[str], copies: list[int]) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the rows that the edits of a segment leave, entered in ``state``."""
    out, at, left = [], 0, copies[0] if copies else 0
    for edit in edits:
        if edit == "I":
            state = NEXT[state]
            out.append((edit, ROLE[state], ""))
            continue
        if edit == "K":
            state = SYSTEM if state == START and roles[at][:1] == "s" else NEXT[state]
            out.append((edit, roles[at], texts[at]))
        elif edit == "R":
            state = NEXT[state]
            out.append((edit, ROLE[state], texts[at]))
        left -= 1
        if not left:
            at += 1
            left = copies[at] if at < len(copies) else 0
    return out


def checked(turns: DataFrame, stored: Stored) -> DataFrame:
    """Different rows (``conv_id``, ``turn``, ``role``, ``text``) with ``copies``, ``initial`` and ``fault``.

    Repeated rows become one with their number before anything is sorted. A row is a
    repetition if its role and text stand at an earlier turn; only the hashes of rows
    that occur at several turns are joined back.
    """
    rows = stored(turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")))
    word = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    h = [F.xxhash64("role", "text"), F.xxhash64(F.lit(7), "text", "role")]
    # a NULL turn comes first
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    known = rows.select("conv_id", "turn", h[0].alias("h1"), h[1].alias("h2"))
    again = known.groupBy(F.col("conv_id").alias("__conv"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2")).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1").drop("n")
    same = [F.col("conv_id").eqNullSafe(F.col("__conv")), h[0] == F.col("__h1"), h[1] == F.col("__h2")]
    later = F.col("first").isNotNull() & (order > F.col("first"))
    return rows.join(replicated_if_small(stored(again)), same, "left").select(
        "conv_id", "turn", "role", "text", "copies", F.substring("role", 1, 1).alias("initial"),
        F.when(~word, BLANK).when(later, REPEATED)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF).otherwise(SOUND).alias("fault"))


_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("seg", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    ("costs", pa.list_(pa.int64())), ("heads", pa.list_(pa.string())), ("middle", pa.string()),
    ("tails", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("copies", pa.list_(pa.int64()))])


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au") or not a or not b


def _segment(conv, seg: int, rows: list[tuple], fresh: bool) -> dict:
    roles, texts, copies, initials, faults = (list(x) for x in zip(*rows))
    pairs = sum(_illegal(a, b) for a, b in zip(initials, initials[1:]))
    repeats = sum(copies) - len(copies)
    blank = sum(n for n, f in zip(copies, faults) if f == BLANK)
    duplicate = sum(f == REPEATED for f in faults) + repeats - sum(n - 1 for n, f in zip(copies, faults) if f == BLANK)
    return {
        "conv_id": conv, "seg": seg, "blank": blank, "duplicate": duplicate, "truncated": faults.count(CUT_OFF),
        "illegal": pairs + repeats, "first": initials[0], "last": initials[-1], "roles": roles, "texts": texts,
        "copies": copies, **transfer(list(zip(initials, faults, copies)), fresh)}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # the first conversation of a task may have begun in the task before
    done, held, size, conv, fresh, any_before = [], [], 0, None, False, False
    number = TaskContext.get().partitionId() << 32

    def close():
        nonlocal held, size, number, fresh
        if held:
            done.append(_segment(conv, number, held, fresh))
            held, size, number, fresh = [], 0, number + 1, False

    written = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "copies", "initial", "fault")]
        for own, role, text, copies, initial, fault in zip(*columns):
            if held and (own != conv or len(held) >= ROWS or size + len(text) > BYTES):
                written += size
                close()
            if own != conv:
                fresh = any_before
            conv, any_before = own, True
            held.append((role, text, copies, initial, fault))
            size += len(text)
            if len(done) >= 256 or written > 16 * BYTES:
                yield pa.RecordBatch.from_pylist(done, _SEGMENT)
                done, written = [], 0
    close()
    if done:
        yield pa.RecordBatch.from_pylist(done, _SEGMENT)


def segments(rows: DataFrame) -> DataFrame:
    """The conversations in order, in segments of at most ``ROWS`` rows, each with its ``transfer``.

    Rows are range-partitioned by conversation, turn, role and text: a conversation of any
    length is spread over as many tasks as it fills, and ``seg`` counts on in its order.
    """
    order = ["conv_id", "turn", "role", "text"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        _segments, "conv_id bigint, seg bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
        "first string, last string, costs array<bigint>, heads array<string>, middle string, tails array<string>, "
        "roles array<string>, texts array<string>, copies array<bigint>")


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[dict]]:
    """The rows of each conversation, one stream after the other."""
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead = next(rows, None)

    def stream(conv):
        nonlocal ahead
        while ahead is not None and ahead["conv_id"] == conv:
            now, ahead = ahead, next(rows, None)
            yield now

    while ahead is not None:
        yield stream(ahead["conv_id"])


def _by_conversation(df: DataFrame) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seg")


def _batched(rows: Iterator[dict], schema: pa.Schema, limit: int = 1024) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def decided(found: DataFrame) -> DataFrame:
    """``seg``, the state it is ``entered`` in, its ``edits``, ``border`` (1 if it and the segment before meet
    illegally) and, at a conversation's last one, its ``cost``."""
    schema = pa.schema([("seg", pa.int64()), ("entered", pa.int32()), ("edits", pa.string()), ("border", pa.int64()),
                        ("cost", pa.int64())])

    def rows(batches):
        for stream in _streams(batches):
            before = None
            for segment, state, edits, cost in joined(stream):
                yield {"seg": segment["seg"], "entered": state, "edits": edits, "cost": cost,
                       "border": int(before is not None and _illegal(before, segment["first"]))}
                before = segment["last"]

    light = found.select("conv_id", "seg", "costs", "heads", "middle", "tails", "first", "last")
    return _by_conversation(light).mapInArrow(
        lambda batches: _batched(rows(batches), schema), "seg bigint, entered int, edits string, border bigint, cost bigint")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("edits", pa.string()), ("rows", pa.list_(row))])
    for batch in batches:
        for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
            yield pa.RecordBatch.from_pylist([
                {"conv_id": s["conv_id"], "seg": s["seg"], "edits": s["edits"], "rows": [
                    dict(zip(("edit", "role", "text"), r))
                    for r in edited(s["edits"], s["entered"], s["roles"], s["texts"], s["copies"])]}
                for s in part.to_pylist()], schema)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations and a report, from ``conv_id``, ``turn``, ``role``, ``text``.

    The first table has a row per segment of a conversation, in the order of ``seg``: its
    ``edits`` and the repaired ``rows`` (``edit``, ``role``, ``text``); ``repaired_turns``
    lists them singly. The second has per conversation ``gaps`` (turn numbers missing),
    ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours that may not follow
    each other) and the least ``cost``.

    A row without a visible character is blank, one whose role and text stood earlier is a
    duplicate, one that does not end in ``.``, ``!`` or ``?`` is truncated; the first of
    these counts. Rows are kept (K), get the role that fits (R), are deleted (D, which
    blank rows and duplicates must be), or user and assistant rows without text are
    inserted (I), until the roles' initials read ``(s?(ua)+)?``. Of the cheapest edits
    the ASCII-least are taken.

    NULL turns come first; rows of one turn are ordered by role and text. A NULL role or
    text is one space, a NULL ``conv_id`` a conversation like others. Repeated rows are
    duplicates. A role other than system, user and assistant counts by its initial; an
    empty one fits nowhere. Texts of any length are kept whole. Other columns are not
    read. An empty table gives empty tables.

    A segment is searched for each state it could be entered in, so a conversation of any
    length is spread over tasks; then the segments' short results are searched in order.
    """
    stored = Stored(turns.sparkSession)
    clean = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("copies").cast("bigint").alias("copies") if "copies" in turns.columns else F.lit(1).cast("bigint").alias("copies"))
    rows = checked(clean, stored)
    found = stored(segments(rows))
    choice = stored(decided(found))
    applied = found.select("conv_id", "seg", "roles", "texts", "copies").join(choice.select("seg", "entered", "edits"), "seg")
    fixed = applied.mapInArrow(
        _applied, "conv_id bigint, seg bigint, edits string, rows array<struct<edit: string, role: string, text: string>>")
    names = ["blank", "duplicate", "truncated", "illegal"]
    sums = found.select("conv_id", "seg", *names).join(choice.select("seg", "border", "cost"), "seg").groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in names[:3]], F.sum(F.col("illegal") + F.col("border")).alias("illegal"),
        F.max("cost").alias("cost"))
    span = clean.groupBy(F.col("conv_id").alias("__conv")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    report = sums.join(span, F.col("conv_id").eqNullSafe(F.col("__conv"))).select("conv_id", "gaps", *names, "cost")
    return fixed, report


def repaired_turns(fixed: DataFrame) -> DataFrame:
    """The repaired rows one by one: ``conv_id``, ``seg``, ``place`` (within the segment), ``edit``, ``role``, ``text``."""
    return fixed.select("conv_id", "seg", F.posexplode("rows").alias("place", "row")).select(
        "conv_id", "seg", "place", "row.edit", "row.role", "row.text")


def digests(fixed: DataFrame) -> DataFrame:
    """``conv_id``, ``audit`` (all edits) and ``repaired_sha256`` of the repaired ``role:text``, joined by line feeds.

    A hash goes through a text from its begin to its end: segments of a conversation are
    read one after the other, and none is held longer than that.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def rows(batches):
        for stream in _streams(batches):
            whole, audit, conv, begun = hashlib.sha256(), [], None, False
            for segment in stream:
                conv = segment["conv_id"]
                audit.append(segment["edits"])
                if segment["body"] is not None:
                    whole.update((b"\n" if begun else b"") + segment["body"].encode())
                    begun = True
            yield {"conv_id": conv, "audit": "".join(audit), "repaired_sha256": whole.hexdigest()}

    body = F.when(F.size("rows") > 0, F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n"))
    return _by_conversation(fixed.select("conv_id", "seg", "edits", body.alias("body"))).mapInArrow(
        lambda batches: _batched(rows(batches), schema), "conv_id bigint, audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, by ``crc32(conv_id:turn) % 20`` (NULLs as one space): 0 drops a row, 1 empties
    its text, 2 removes the marks that end sentences, 3 repeats it (``copies``), 4 makes it the user's."""
    def shown(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.coalesce("text", F.lit(" "))
    return turns.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"))


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every conversation of ``conversations`` after ``damaged`` and ``repair``: counts, cost, audit and hash."""
    fixed, report = repair(damaged(conversations))
    stored = Stored(conversations.sparkSession)
    audits = stored(digests(fixed)).withColumnRenamed("conv_id", "__audited")
    report = stored(report).withColumnRenamed("conv_id", "__reported")
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(report, F.col("conv_id").eqNullSafe(F.col("__reported")), "left").join(
        audits, F.col("conv_id").eqNullSafe(F.col("__audited")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
