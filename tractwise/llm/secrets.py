"""Secret scans: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tractwise.llm.tables import Stored

CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
WORD = re.compile(r"[^\s=:\"'`,;(){}<>\[\]]+")
LETTERS = re.compile(r"[A-Za-z]{3,}")
#: Words beside a value that speak for a credential (fixed values).
HINTS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "key", "auth", "bearer", "credential")
NEAR = 40
CLASSES = "luds"  # lower, upper, digit, symbol
FEATURES = (
    "length", "distinct", "entropy", "digits", "uppers", "symbols", "changes",
    *[f"from_{a}_to_{b}" for a in CLASSES for b in CLASSES],
    "coverage", "path", "hint_before", "hint_after", "assigned", "quoted", "word_before", "word_after",
)
SCHEMA = "doc_id bigint, start int, end int, candidate string, before string, " + ", ".join(
    f"{f} double" for f in FEATURES)


def _bucket(word: str, n: int = 64) -> float:
    import zlib

    return float(zlib.crc32(word.lower().encode()) % n)


def _covered(text: str, words: frozenset) -> float:
    """The share of the characters that the longest dictionary words, from left to right, cover."""
    total = 0
    for run in LETTERS.findall(text):
        run, at = run.lower(), 0
        while at < len(run) - 2:
            end = next((e for e in range(min(len(run), at + 12), at + 2, -1) if run[at:e] in words), 0)
            total += max(0, end - at)
            at = end or at + 1
    return total / len(text)


def _features(text: str, start: int, end: int, path: str, words: frozenset) -> list[float]:
    own = text[start:end]
    n = len(own)
    kinds = ["l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "s" for c in own]
    steps = Counter(zip(kinds, kinds[1:]))
    chars = Counter(own)
    before, after = text[max(0, start - NEAR): start], text[end: end + NEAR]
    left, right = WORD.findall(before), WORD.findall(after)
    mark = before.rstrip()
    return [
        float(n), len(chars) / n, -sum(k / n * math.log2(k / n) for k in chars.values()),
        kinds.count("d") / n, kinds.count("u") / n, kinds.count("s") / n,
        sum(k for (a, b), k in steps.items() if a != b) / n,
        *[steps[a, b] / n for a in CLASSES for b in CLASSES],
        _covered(own, words), _bucket(path),
        float(any(h in w.lower() for w in left[-2:] for h in HINTS)),
        float(any(h in w.lower() for w in right[:2] for h in HINTS)),
        float(mark.rstrip("\"'`").rstrip().endswith(("=", ":"))), float(mark[-1:] in "\"'`" and mark != ""),
        _bucket(left[-1]) if left else -1.0, _bucket(right[0]) if right else -1.0,
    ]


def _found(dictionary):
    def run(batches: Iterator[pa.RecordBatch]):
        words = dictionary.value
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), *[pa.float64()] * len(FEATURES)]
        names = ["doc_id", "start", "end", "candidate", "before", *FEATURES]
        for batch in batches:
            rows = []
            for doc, text, path in zip(*[c.to_pylist() for c in batch.columns]):
                for m in CANDIDATE.finditer(text or ""):
                    near = text[max(0, m.start() - NEAR): m.start()]
                    rows.append((doc, m.start(), m.end(), m[0], near,
                                 *_features(text, m.start(), m.end(), path or "", words)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    return run


def dictionary(docs: DataFrame, text_column: str = "text", share: float = 1e-5) -> frozenset:
    """Words of three to twelve ASCII letters that make up at least ``share`` of all words.

    All texts are counted; at most ``1 / share`` words come to the driver.
    """
    word = F.explode(F.split(F.lower(F.coalesce(F.col(text_column), F.lit(""))), r"[\s.,;:!?]+"))
    counts = Stored(docs.sparkSession)(docs.select(word.alias("word")).groupBy("word").count())
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    often = counts.where((F.col("count") >= max(1, share * total)) & F.col("word").rlike("^[a-z]{3,12}$"))
    return frozenset(r[0] for r in often.select("word").collect())


def candidates(
    docs: DataFrame, words: frozenset, *, id_column: str = "doc_id", text_column: str = "text",
    path_column: str = "source",
) -> DataFrame:
    """Every candidate of every text with its place and ``FEATURES``.

    A candidate is a run of 16 or more letters, digits and ``+/_-``. Features: length,
    spread and kinds of its characters and the transitions between kinds, how much of it
    dictionary words cover, the path, and the words and marks beside it. NULL and empty
    texts have none; each repeated row gives its own; a NULL path is an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"),
                       F.col(path_column).cast("string").alias("path"))
    return rows.mapInArrow(_found(shared), SCHEMA)


def known_kind(candidate: Column, before: Column) -> Column:
    """1 for candidates that are a known kind of credential, 0 for words and numbers, NULL if not sure.

    Sure credentials are provider keys, and digits mixed with letters that follow an
    assignment to a name for a secret; sure others are letters alone or digits alone
    (accounts, cards, telephones) without such a name before them.
    """
    provider = candidate.rlike(r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_live_[A-Za-z0-9]{16,}$")
    named = before.rlike(r"(?i)(pass(word|wd)?|pwd|secret|token|key|auth)[\"']?\s*[=:]\s*[\"']?$")
    mixed = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
    return F.when(provider | (named & mixed), 1.0).when(~candidate.rlike("[0-9]"), 0.0).when(
        ~candidate.rlike("[A-Za-z]") & ~named, 0.0)


def train(labelled: DataFrame, *, max_labelled: int = 20_000, trees: int = 30, depth: int = 8, seed: int = 7) -> PipelineModel:
    """A random forest on ``FEATURES`` from findings with ``label`` 0 or 1.

    At most ``max_labelled`` rows are used, half of them of each label if there are as
    many, chosen by the hash of id and place. Rows without a label are left out. If only
    one label occurs, the forest always gives that one.
    """
    rows = labelled.where("label is not null").select("doc_id", "start", "label", *FEATURES)
    order = F.xxhash64("doc_id", "start")
    half = [rows.where(F.col("label") == x).orderBy(order).limit(max_labelled // 2) for x in (0, 1)]
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features")
    fitted = Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(half[0].unionByName(half[1]))
    # a copy has no training summary, which holds the session: one that has observed anything cannot go to tasks
    return PipelineModel(stages=[*fitted.stages[:-1], fitted.stages[-1].copy()])


def scan(found: DataFrame, model: PipelineModel | None, threshold: float = 0.5) -> DataFrame:
    """``found`` with the forest's ``probability`` of a secret and ``is_secret``; without a model nothing is one."""
    if model is None:
        scored = found.withColumn("probability", F.lit(0.0))
    else:
        chance = vector_to_array(F.col("probability"))
        scored = model.transform(found).withColumn("probability", F.coalesce(F.get(chance, F.lit(1)), F.lit(0.0)))
    return scored.withColumn("is_secret", F.col("probability") >= threshold).select(
        "doc_id", "start", "end", "candidate", "probability", "is_secret")


def scan_documents(docs: DataFrame, **columns) -> DataFrame:
    """Findings of whole texts after the removal of false positives.

    The labelled findings are the candidates of ``docs`` of which ``known_kind`` is
    sure; the forest decides on all. A table without such candidates has no findings.
    """
    stored = Stored(docs.sparkSession)
    found = stored(candidates(docs, dictionary(docs, columns.get("text_column", "text")), **columns))
    labelled = found.withColumn("label", known_kind(F.col("candidate"), F.col("before")))
    model = train(labelled) if labelled.where("label is not null").limit(1).count() else None
    return scan(found, model).where("is_secret").drop("is_secret")
