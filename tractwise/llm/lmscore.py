"""Language-model scoring: the difference of cross-entropies under two n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tractwise.llm.tables import Stored
from tractwise.llm.text import mixed, salt, word_hashes
from tractwise.session import replicated_if_small

#: Texts are counted and scored in parts of so many rows, and counts handed on from so many entries.
PART, ENTRIES = 200, 1_000_000
#: What stands before a word where it is counted alone; the models' weight of pairs and the count added to words.
ALONE, WEIGHT, ADD = 0, 0.5, 0.5


def _grams(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words, then all pairs of neighbours in a text: what stands before, the word, a hash of both, the text."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    before = np.concatenate([np.full(len(words), ALONE, np.uint64), words[at - 1]])
    word = np.concatenate([words, words[at]])
    return before, word, _gram(before, word), np.concatenate([owner, owner[at]])


def _gram(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(3) ^ mixed(word ^ salt(1)))


def _summed(parts: list[tuple]) -> tuple:
    before, word, gram, target, background = (np.concatenate(x) for x in zip(*parts))
    gram, first, place = np.unique(gram, return_index=True, return_inverse=True)
    return (before[first], word[first], gram, np.bincount(place, target, len(gram)).astype(np.int64),
            np.bincount(place, background, len(gram)).astype(np.int64))


def _counted(batches: Iterator[pa.RecordBatch]):
    """Counts of words and word pairs of a task: what stands before, the word, in target texts, in all texts."""
    held: list[tuple] = []  # so a task's memory is bounded, whatever its share of texts

    def out():
        if held:
            before, word, _, target, background = _summed(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(before.view(np.int64)), pa.array(word.view(np.int64)), pa.array(target), pa.array(background)],
                ["before", "word", "target", "background"])
        held.clear()

    for batch in batches:
        for start in range(0, batch.num_rows, PART):
            part = batch.slice(start, PART)
            before, word, gram, owner = _grams(*word_hashes(part.column("text")))
            chosen = part.column("chosen").to_numpy(zero_copy_only=False).astype(bool)
            held.append(_summed([(before, word, gram, chosen[owner].astype(np.int64), np.ones(len(gram), np.int64))]))
            if sum(len(p[0]) for p in held) > ENTRIES:
                yield from out()
    yield from out()


def _weights(counts: DataFrame, sizes: tuple[int, int], stored: Stored) -> tuple[DataFrame, list[float]]:
    """What each kept word and pair adds to a text's losses, and the loss of an unknown word, under both models.

    A token's loss is that of an unknown word in a pair never seen, plus what its word
    adds, plus what the pair with the word before adds. The counts of the background are
    scaled to the size of the target, so both models are smoothed alike.
    """
    single = stored(counts.where(f"before = {ALONE} and background > 1").drop("before"))
    pairs = counts.where(f"before <> {ALONE} and background > 1")
    n, *held = single.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0)), F.coalesce(F.sum("background"), F.lit(0))).first()
    size = max(1, sizes[0])
    scale = (1.0, size / max(1, sizes[1]))
    total = size + ADD * (n + 1)
    unknown = [max(0.0, size - held[i] * scale[i]) for i in (0, 1)]
    base = [-float(np.log((1 - WEIGHT) * (unknown[i] + ADD) / total)) for i in (0, 1)]

    def alone(i: int, count: str) -> Column:
        return (F.coalesce(F.col(count) * scale[i], F.lit(unknown[i])) + ADD) / total

    def paired(i: int, count: str) -> Column:
        before = F.coalesce(F.col(f"b{count}") * scale[i], F.lit(unknown[i]))
        joint = F.when(before > 0, F.least(F.col(count) * scale[i] / before, F.lit(1.0))).otherwise(0.0)
        rest = (1 - WEIGHT) * alone(i, f"w{count}")
        return F.log(rest) - F.log(WEIGHT * joint + rest)

    kinds = ("target", "background")
    words = single.select(
        F.lit(ALONE).cast("bigint").alias("before"), "word", "background",
        *[(-F.log((1 - WEIGHT) * alone(i, c)) - base[i]).alias(f"add_{c}") for i, c in enumerate(kinds)])
    side = replicated_if_small(single)
    of_word = side.toDF("word", "wtarget", "wbackground")
    of_before = side.toDF("before", "btarget", "bbackground")
    joined = pairs.join(of_word, "word", "left").join(of_before, "before", "left")
    added = joined.select("before", "word", "background", *[paired(i, c).alias(f"add_{c}") for i, c in enumerate(kinds)])
    return stored(words.unionByName(added)), base


def _scored(common, base: list[float]):
    """Of each text a row with what ``common`` entries make of its losses, and a row for each other entry in it."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for start in range(0, batch.num_rows, PART):
                part = batch.slice(start, PART)
                words, ends = word_hashes(part.column("text"))
                before, word, gram, owner = _grams(words, ends)
                table, *adds = common.value
                at = np.searchsorted(table, gram)
                at[at == len(table)] = 0
                there = table[at] == gram if len(table) else np.zeros(len(gram), bool)
                n = np.diff(ends)
                sums = [np.bincount(owner[there], add[at[there]], len(n)) + n * b + (n > 0) * np.log(1 - WEIGHT)
                        for add, b in zip(adds, base)]  # a first word has no pair, so it keeps its whole chance
                left = np.flatnonzero(~there)
                left = left[np.lexsort((gram[left], owner[left]))]
                new = np.ones(len(left), bool)
                new[1:] = (gram[left][1:] != gram[left][:-1]) | (owner[left][1:] != owner[left][:-1])
                times = np.diff(np.append(np.flatnonzero(new), len(left)))
                left = left[new]
                # a text's own row has a key that no entry has, so these rows are dealt evenly
                none, ids = np.zeros(len(left), np.int64), np.concatenate([np.arange(len(n)), owner[left]])
                key = part.column("key").to_numpy()
                columns = {
                    "doc_id": part.column("doc_id").take(pa.array(ids)), "key": pa.array(key[ids]),
                    "copies": pa.array(np.concatenate([np.ones(len(n), np.int64), none])),
                    "n_tokens": pa.array(np.concatenate([n.astype(np.int64), none])),
                    "before": pa.array(np.concatenate([key, before[left].view(np.int64)])),
                    "word": pa.array(np.concatenate([mixed(key.view(np.uint64)), word[left]]).view(np.int64)),
                    "times": pa.array(np.concatenate([np.zeros(len(n), np.int64), times])),
                    "target": pa.array(np.concatenate([sums[0], none])), "background": pa.array(np.concatenate([sums[1], none])),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    return run


def cross_entropy_difference(
    docs: DataFrame, *, chosen_column: str, share: float = 1e-6, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Every row's cross-entropy under a model of the chosen rows less that under one of all rows.

    Columns: ``doc_id``, ``n_tokens``, ``target_loss``, ``background_loss`` (nats per
    token) and ``difference`` (Moore and Lewis 2010): the lower, the more alike the text
    is to the chosen rows, those whose ``chosen_column`` is true. Tokens are the
    ASCII-lower-cased words between ASCII white space. NULL and empty texts have no
    tokens and NULL losses; a NULL in ``chosen_column`` counts as false. Repeated rows
    count as often as they occur. Without chosen rows the target model knows no word.

    All words and word pairs of all texts are counted: in the tasks first, then by a
    shuffle of their hashes. The models hold all that occur twice, whatever the size of
    the input; other words are one unknown word. What an entry adds to a text's losses is
    joined to the texts' own counts and summed per text. Entries that make up at least
    ``share`` of all tokens, so at most ``1 / share`` words and as many pairs, are
    broadcast instead (24 bytes each), so no key of the join is frequent.
    """
    spark = docs.sparkSession
    stored = Stored(spark)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
        F.coalesce(F.col(chosen_column).cast("boolean"), F.lit(False)).alias("chosen"))
    counted = rows.mapInArrow(_counted, "before bigint, word bigint, target bigint, background bigint")
    counts = stored(
        counted.groupBy("before", "word").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
        .where(f"background > 1 or before = {ALONE}"))
    sizes = counts.where(f"before = {ALONE}").agg(
        F.coalesce(F.sum("target"), F.lit(0)), F.coalesce(F.sum("background"), F.lit(0))).first()
    weights, base = _weights(counts, tuple(sizes), stored)
    often = F.col("background") >= share * sizes[1]
    kept = weights.where(often).toPandas()
    gram = _gram(kept.before.to_numpy(np.int64).view(np.uint64), kept.word.to_numpy(np.int64).view(np.uint64))
    order = np.argsort(gram)
    common = spark.sparkContext.broadcast(
        (gram[order], kept.add_target.to_numpy(float)[order], kept.add_background.to_numpy(float)[order]))
    kind = dict(rows.dtypes)["doc_id"]
    parts = rows.select("doc_id", "text", F.xxhash64("text").alias("key")).mapInArrow(
        _scored(common, base), f"doc_id {kind}, key bigint, copies bigint, n_tokens bigint, before bigint, word bigint, "
        "times bigint, target double, background double")

    def total(kind: str) -> Column:
        return F.sum(F.col(kind) + F.col("times") * F.coalesce(f"add_{kind}", F.lit(0.0)))

    # rows of one id and text are summed as one and given back as often as they occur
    texts = parts.join(weights.where(~often).drop("background"), ["before", "word"], "left").groupBy("doc_id", "key").agg(
        F.sum("copies").alias("copies"), F.max("n_tokens").alias("n_tokens"), total("target").alias("t"), total("background").alias("b"))
    tokens = F.when(F.col("n_tokens") > 0, F.col("copies") * F.col("n_tokens"))
    return texts.select(
        "doc_id", "n_tokens", (F.col("t") / tokens).alias("target_loss"), (F.col("b") / tokens).alias("background_loss"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")).select(
        "doc_id", "n_tokens", "target_loss", "background_loss",
        (F.col("target_loss") - F.col("background_loss")).alias("difference"))
