"""Online packing by the sum of squares: each document goes to the fill level that keeps levels even."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tractwise.llm.tokens import checksum, default_tokenizer, slices, vocabulary

#: Open windows of one stream; beyond it they are settled and the levels begin anew. A bound on memory only.
OPEN = 4096
FAR = np.int64(1) << 40


class Piece:
    """Ids ``start`` to ``start + len(ids)`` of a document of ``total`` ids."""

    __slots__ = ("doc", "total", "start", "ids")

    def __init__(self, doc, total: int, start: int, ids: np.ndarray):
        self.doc, self.total, self.start, self.ids = doc, total, start, ids

    def cut(self, n: int) -> Piece:
        """Takes the last ``n`` ids away, as a piece of their own."""
        keep = len(self.ids) - n
        tail = Piece(self.doc, self.total, self.start + keep, self.ids[keep:])
        self.ids = self.ids[:keep]
        return tail


class Levels:
    """How many partially filled windows there are at each fill level, and which.

    A window whose fill is a power of two needs no padding: it stays open, but its level
    counts as filled, at no cost. ``enter`` is what one more window at a level adds to
    the sum of squares, ``leave`` what one less takes away (impossible where there is none).
    """

    def __init__(self, size: int):
        self.size = size
        self.open: list[list[list[Piece]]] = [[] for _ in range(size)]
        self.n_open = 0
        self.filled = np.zeros(size + 1, bool)
        self.filled[[1 << k for k in range(size.bit_length()) if 1 << k <= size]] = True
        self.filled[size] = True
        self.enter = np.where(self.filled, 0, 1).astype(np.int64)
        self.leave = np.full(size, -FAR)

    def best(self, n: int) -> int:
        """The level, 0 for a new window, to which ``n`` more ids are added at the least sum; the fullest of equals."""
        if n == self.size:
            return 0
        costs = self.enter[n + 1:] - self.leave[1: self.size - n + 1]
        at = len(costs) - 1 - int(costs[::-1].argmin())
        return at + 1 if costs[at] <= self.enter[n] else 0

    def _count(self, level: int) -> None:
        n = len(self.open[level])
        self.enter[level] = 0 if self.filled[level] else 2 * n + 1
        self.leave[level] = -FAR if n == 0 else 0 if self.filled[level] else 2 * n - 1

    def take(self, level: int) -> list[Piece]:
        self.n_open -= 1
        window = self.open[level].pop()
        self._count(level)
        return window

    def put(self, level: int, window: list[Piece]) -> None:
        self.n_open += 1
        self.open[level].append(window)
        self._count(level)

    def drain(self) -> list[tuple[int, list[Piece]]]:
        """All open windows with their fill, the fullest first; none is left."""
        windows = [(level, w) for level in range(self.size - 1, 0, -1) for w in self.open[level]]
        self.__init__(self.size)
        return windows


def _moved(source: list[Piece], n: int) -> list[Piece]:
    """The last ``n`` ids of a window, taken from it: whole pieces, and at most one cut."""
    taken = []
    while n > 0:
        piece = source.pop() if len(source[-1].ids) <= n else source[-1].cut(n)
        taken.append(piece)
        n -= len(piece.ids)
    return taken


def settled(windows: list[tuple[int, list[Piece]]], size: int, filled: np.ndarray) -> Iterator[list[Piece]]:
    """Partially filled ``windows`` (fullest first) made into such that need no padding.

    Those that need none stay. The others are first put together whole, best fit first;
    then each window left is filled by a piece cut from the emptiest one, and the last
    one is parted at powers of two.
    """
    spaces: list[tuple[int, int]] = []
    bins: list[tuple[int, list[Piece]]] = []
    for level, window in windows:
        if filled[level]:
            yield window
            continue
        at = bisect_left(spaces, (level, -1))
        if at < len(spaces):
            space, i = spaces.pop(at)
            bins[i] = (bins[i][0] + level, bins[i][1] + window)
            if space > level:
                insort(spaces, (space - level, i))
        else:
            insort(spaces, (size - level, len(bins)))
            bins.append((level, window))
    rest = []
    for level, window in bins:
        if filled[level]:
            yield window
        else:
            rest.append((level, window))
    rest.sort(key=lambda x: -x[0])
    first, last = 0, len(rest) - 1
    while first < last:
        level, window = rest[first]
        other, source = rest[last]
        n = min(size - level, other)
        rest[first], rest[last] = (level + n, window + _moved(source, n)), (other - n, source)
        if filled[other - n] and other > n:  # what is left needs no padding
            yield source
            last -= 1
        elif other == n:
            last -= 1
        if filled[level + n]:
            yield rest[first][1]
            first += 1
    if first == last:
        level, window = rest[first]
        while level:
            n = 1 << level.bit_length() - 1
            yield _moved(window, min(n, level))
            level -= n


def placed(items: Iterator[tuple[object, np.ndarray]], levels: Levels) -> Iterator[list[Piece]]:
    """Windows as they are filled, from documents and their ids in order.

    Of a document longer than a window the first ids fill windows of their own and the
    rest is placed. The windows still open at the end are settled.
    """
    size = levels.size
    for doc, ids in items:
        total = len(ids)
        for start in range(0, total - size + 1, size):
            yield [Piece(doc, total, start, ids[start: start + size])]
        n = total % size
        if n == 0:
            continue
        piece = Piece(doc, total, total - n, ids[total - n:])
        level = levels.best(n)
        window = [*levels.take(level), piece] if level else [piece]
        if level + n == size:
            yield window
        else:
            levels.put(level + n, window)
        if levels.n_open > OPEN:
            yield from settled(levels.drain(), size, levels.filled)
    yield from settled(levels.drain(), size, levels.filled)


_FIELDS = (("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()))


def _packed(path: str, size: int, end: int, keep_ids: bool):
    fields = _FIELDS[: len(_FIELDS) - 1 + keep_ids]

    def documents(batches: Iterator[pa.RecordBatch]):
        encode = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, begin = encode(part.column("text"), end)
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    yield doc, ids[begin[i]: begin[i + 1]].copy()  # an open window keeps its own ids alone

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]):
        rows, sequence = [], TaskContext.get().partitionId() << 40
        for window in placed(documents(batches), Levels(size)):
            offset = 0
            for p in window:
                row = (p.doc, p.start, len(p.ids), checksum(p.ids), p.total, sequence, offset)
                rows.append((*row, p.ids.astype("<u4").tobytes()) if keep_ids else row)
                offset += len(p.ids)
            sequence += 1
            if len(rows) >= 4096:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)
    return run


def pack_online(
    docs: DataFrame, *, tokenizer: str | None = None, size: int = 2048, end: int = 1, keep_ids: bool = False,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """All rows of ``docs`` as pieces in sequences of at most ``size`` tokens, in one pass without a shuffle.

    Columns: ``doc_id``, ``start`` (the document's ids before the piece), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (gapless) and, on request,
    ``ids`` (little-endian unsigned 32-bit). Each text is closed by id ``end``.

    Every task packs the rows it reads as a stream. A document goes to the fill level at
    which the sum of the squared counts of partially filled windows is least; a window
    whose length is a power of two counts as filled, as it needs no padding. What is
    open at the end of a stream is put together and cut so that every sequence is full
    or a power of two long: there is no padding. A task holds its counts and at most
    ``OPEN`` open windows; when there are more, they are settled at once.

    NULL and empty texts are the closing id alone. Texts of any length are packed whole.
    Rows that repeat an id, or have none, are packed each for itself. Only the id and the
    text are read, so other columns may have any name. An empty table gives an empty
    result. Sequence numbers name the task and the window, so a task that is repeated
    after a lost executor gives the same rows.
    """
    kinds = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
             "sequence_id bigint, offset bigint")
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(
        _packed(tokenizer or default_tokenizer(), size, end, keep_ids), kinds + ", ids binary" * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from ``pack_online(..., keep_ids=True)``: ``sequence_id``, ``ids`` and
    ``parts`` (``offset``, ``doc_id``, ``start``, ``length``); at most a window's ids in a row."""
    part = F.struct("offset", "doc_id", "start", "length", "ids")
    ordered = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("all"))
    return ordered.select(
        "sequence_id", F.expr("aggregate(all, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
        F.transform("all", lambda x: F.struct(x["offset"], x["doc_id"], x["start"], x["length"])).alias("parts"))
