"""Near-duplicate documents: SetSketch registers, banding, likelihood, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tractwise.llm.graph import components
from tractwise.llm.tables import Stored
from tractwise.llm.text import mixed, salt, shingle_sets, word_hashes
from tractwise.session import replicated_if_small

#: Base of the register scale, rate of the exponentials, and largest register value: one
#: byte holds minima between 1 / rate and 1e-12.
BASE, RATE, TOP = 1.1, 20.0, 255
#: 64 bands of 7 registers: a pair with similarity 0.85 is in no band together once in
#: 10 ** 11, one with 0.8 once in 10 ** 7.
BANDS, ROWS = 64, 7
REGISTERS = BANDS * ROWS
#: Buckets up to this size are compared pair by pair, larger ones as a group: both are exact.
PAIRWISE = 32
#: Shingles (with 256 more per document) that a verifying task takes at once, twice over.
BLOCK = 400_000


def sketches(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SetSketch registers (Ertl 2021) of sets, one row of bytes per set.

    A register is the smallest of the set's exponential variates, truncated to a
    logarithmic scale: floor(1 - log_base(minimum)) within a byte. Registers of a union
    are the larger ones, and those of two sets agree about as often as the sets do. The
    variates of an element come as a Poisson process that deals its points to the
    registers; points beyond a bound that is all but surely above every minimum are not
    made, and where a register stays empty the bound is raised and the set done again.
    """
    m, total = REGISTERS, len(ends) - 1
    sizes = np.diff(ends)
    lowest = np.full((total, m), np.inf)
    todo, margin = np.flatnonzero(sizes > 0), 4.0
    while len(todo):
        bound = (np.log(m) + margin) / sizes[todo]
        n = sizes[todo]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[:-1][todo], n)
        state, owner, limit = shingles[at], np.repeat(todo, n), np.repeat(bound, n)
        time, step = np.zeros(len(state)), 0
        while len(state):
            step += 1
            drawn = mixed(state + salt(step))
            time = time - np.log1p(-((drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / m
            stay = time <= limit
            state, owner, limit, time, drawn = state[stay], owner[stay], limit[stay], time[stay], drawn[stay]
            register = (mixed(drawn) % np.uint64(m)).astype(np.int64)
            np.minimum.at(lowest.reshape(-1), owner * m + register, time)
        todo = todo[np.isinf(lowest[todo]).any(axis=1)]
        margin *= 3
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(np.maximum(lowest, 1e-300) / RATE) / np.log(BASE))
    return np.clip(np.where(np.isinf(lowest), 0, level), 0, TOP).astype(np.uint8)


def _chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4_000_000):
    """Rows of batches in parts of about ``limit`` bytes of text."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _sketched(size: int):
    def run(batches):
        for batch in _chunks(batches, "text"):
            shingles, ends = shingle_sets(*word_hashes(batch.column("text")), size)
            rows = sketches(shingles, ends)
            n = np.diff(ends)
            sums = [np.add.reduceat(np.append(mixed(shingles ^ np.uint64(k)), np.uint64(0)), ends[:-1]) * (n > 0)
                    for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n.astype(np.int64)),
                *[pa.array(x.astype(np.uint64).view(np.int64)) for x in sums],
                pa.array([r.tobytes() for r in rows], pa.binary()),
            ], ["doc_id", "n", "h1", "h2", "sketch"])
    return run


def jaccard(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarity of pairs of sets with known sizes.

    From the counts of registers where the one is larger, the other is larger, and both
    agree; the log-likelihood is concave, so its maximum is found by ternary search.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def fit(j):
        def p(x):
            return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

        x, y = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return more * np.log(x + tiny) + less * np.log(y + tiny) + same * np.log(np.maximum(1 - x - y, tiny))

    for _ in range(40):
        one, two = low + (high - low) / 3, high - (high - low) / 3
        up = fit(one) < fit(two)
        low, high = np.where(up, one, low), np.where(up, high, two)
    return (low + high) / 2


def _likely(least: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS)
                    for c in ("su", "sv"))
            there = jaccard(a, b, batch.column("nu").to_numpy(), batch.column("nv").to_numpy()) >= least
            yield batch.select(["u", "v"]).filter(pa.array(there))
    return run


def _sets(size: int):
    def run(batches):
        for batch in _chunks(batches, "text"):
            shingles, ends = shingle_sets(*word_hashes(batch.column("text")), size)
            rows = [shingles[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "component", "bin", "blocks", "block")],
                 pa.array(rows, pa.binary())],
                ["doc_id", "component", "bin", "blocks", "block", "shingles"])
    return run


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the index of the first of those it is linked with, directly or not."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    at = place[code]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, 8_000_000 // max(1, len(sets)))
    for start in range(0, len(shared), width):
        lo, hi = np.searchsorted(at, [start, start + width])
        part = np.zeros((len(sets), min(width, len(shared) - start)), np.float32)
        part[owner[lo:hi], at[lo:hi] - start] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    link = 100 * both.astype(np.float64) >= percent * union.astype(np.float64)
    label = np.arange(len(sets))
    while True:
        new = np.where(link, label[None, :], len(sets)).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verified(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        u, v = [], []
        for _, rows in group.drop_duplicates(["component", "doc_id"]).groupby("component", sort=False):
            if len(rows) < 2:
                continue
            ids = rows.doc_id.to_numpy()
            label = _linked([np.frombuffer(s, np.uint64) for s in rows.shingles], percent)
            there = label != np.arange(len(ids))
            u.append(ids[there])
            v.append(ids[label[there]])
        none = np.array([], np.int64)
        return pd.DataFrame({"u": np.concatenate([none, *u]), "v": np.concatenate([none, *v])})
    return run


def near_duplicates(
    docs: DataFrame, *, percent: int = 85, shingle: int = 5, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class_id``, ``component_id`` and ``kept`` of every row of ``docs``.

    Two documents are linked if ``100 * |A and B| >= percent * |A or B|`` for their sets
    of ``shingle``-word shingles (ASCII-lower-cased words between ASCII white space; with
    fewer words the whole sequence is one shingle). Those with equal sets are one class,
    named by its smallest id. A component is what links connect, named by its smallest
    id, and that document is ``kept``.

    Every set is sketched in one pass over the texts. Classes are banded on register
    values; buckets of up to ``PAIRWISE`` classes give pairs, of which the joint
    likelihood of the registers keeps those that may reach the threshold (six standard
    deviations below it); all members of a larger bucket stay together. What this
    connects is verified on the full sets, in blocks of bounded size: a task compares
    two blocks by a product of their incidence matrices and returns only which members
    are connected, so a group of any size gives rows in proportion to its members.

    Empty and NULL texts have the empty set and no link. Rows that repeat an id are one
    document if their texts agree (texts that differ are linked through the id). A row
    without an id has no component and is kept. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    stored = Stored(spark)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    sketched = stored(docs.mapInArrow(
        _sketched(shingle), "doc_id bigint, n bigint, h1 bigint, h2 bigint, sketch binary"))
    some = sketched.where("n > 0 and doc_id is not null")
    classes = stored(some.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("class_id")))
    keys = ["n", "h1", "h2"]
    members = stored(sketched.drop("sketch").join(classes, keys, "left").select("doc_id", "n", "class_id"))
    firsts = some.join(classes.withColumnRenamed("class_id", "doc_id"), [*keys, "doc_id"], "left_semi")
    reps = stored(firsts.select("doc_id", "n", "sketch").dropDuplicates(["doc_id"]))

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substr(F.col("sketch"), i * ROWS + 1, F.lit(ROWS))))
    banded = reps.select(F.col("doc_id").alias("u"), "n", F.explode(bands).alias("band"))
    buckets = stored(
        banded.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("u").alias("leader")).where("size > 1"))
    gathered = stored(banded.join(replicated_if_small(buckets), "band"))
    small = gathered.where(F.col("size") <= PAIRWISE).select("band", "u", "n")
    other = small.select("band", F.col("u").alias("v"), F.col("n").alias("nv"))
    may = (100 * F.least("n", "nv") >= percent * F.greatest("n", "nv")) & (F.col("u") < F.col("v"))
    pairs = small.join(other, "band").where(may).select("u", "v").distinct()
    sketch = reps.select(F.col("doc_id"), "n", "sketch")
    ends = pairs.join(sketch.toDF("u", "nu", "su"), "u").join(sketch.toDF("v", "nv", "sv"), "v")
    t = percent / 100
    least = t - 6 * (t * (1 - t) / REGISTERS) ** 0.5
    likely = ends.mapInArrow(_likely(least), "u bigint, v bigint")
    kept_together = gathered.where((F.col("size") > PAIRWISE) & (F.col("u") != F.col("leader"))).select(
        "u", F.col("leader").alias("v"))
    candidates = components(likely.unionByName(kept_together), stored)

    weighed = candidates.join(reps.select(F.col("doc_id").alias("node"), (F.col("n") + 256).alias("w")), "node")
    totals = weighed.groupBy("component").agg(F.sum("w").alias("w"))
    totals = stored(totals.select("component", F.ceil(F.col("w") / BLOCK).cast("int").alias("blocks"), "w"))
    everything = totals.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    bins = max(1, everything // BLOCK)
    placed = stored(
        candidates.join(totals.drop("w"), "component").select(
            F.col("node").alias("doc_id"), "component", "blocks",
            F.when(F.col("blocks") > 1, F.xxhash64("component")).otherwise(
                F.pmod(F.xxhash64("component"), F.lit(bins))).alias("bin"),
            F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block")))
    sets = docs.join(replicated_if_small(placed), "doc_id").select(
        "doc_id", "text", "component", "bin", "blocks", "block")
    sets = sets.mapInArrow(
        _sets(shingle), "doc_id bigint, component bigint, bin bigint, blocks int, block int, shingles binary")
    # each member meets all blocks of its component but its own, or itself if that is the only one
    against = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block")))
    tasks = sets.withColumn("other", F.explode(against)).select(
        "doc_id", "component", "shingles", "bin", (F.col("blocks") > 1).alias("split"),
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    links = tasks.groupBy("bin", "split", "i", "j").applyInPandas(_verified(percent), "u bigint, v bigint")
    found = components(links, stored)
    label = found.select(F.col("node").alias("class_id"), "component")
    return members.join(label, "class_id", "left").select(
        F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"),
        F.coalesce("component", "class_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "class_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"), "class_id")


def dedup_documents(docs: DataFrame, *, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document is kept: the first of each component.

    Rows that repeat the kept id stay once each with their columns.
    """
    found = near_duplicates(docs, id_column=id_column, **options)
    gone = found.where("not kept").select(F.col(id_column).alias("__id")).distinct()
    return docs.join(replicated_if_small(Stored(docs.sparkSession)(gone)),
                     F.col(id_column) == F.col("__id"), "left_anti")
