"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tractwise.llm import lines, minhash, mixing, packing, quality
from tractwise.llm.tables import Stored
from tractwise.session import replicated_if_small, scratch_path

#: Similarity, in percent, from which documents of the pipeline are near duplicates.
NEAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, with all their columns.

    A verdict belongs to an id and a text: of rows that share an id each has its own, and
    rows without an id are judged too. NULL and empty texts have no words and go, as texts
    of fewer than 50 words do; long ones are judged whole. Repeated rows stay or go
    together. An empty table stays empty.
    """
    shown = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit("")))
    keyed = docs.select("text", "lang", "source", F.md5(shown).alias("__key"))
    verdicts = quality.quality_rules(keyed, id_column="__key")
    gone = Stored(spark)(verdicts.where("not kept").select("__key").distinct())
    return docs.join(replicated_if_small(gone), F.md5(shown) == F.col("__key"), "left_anti")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines kept elsewhere; those left without a line go.

    Of equal or similar lines the one of the smallest id, then place, stays; see
    ``lines.duplicate_lines``. ``n_chars`` of a changed text is counted anew, other columns
    stay. Rows without an id stay as they are; repeated rows are one document and are
    changed alike. NULL and empty texts had no line to lose and stay, lines of any length
    are compared whole, and an empty table stays empty.
    """
    cleaned = lines.dedup_lines(docs)
    some = F.col("dropped_lines").isNull() | F.col("text").rlike(quality.WORD)
    text = F.col("text")
    return cleaned.where(some).select(*[
        F.when(F.col("dropped_lines").isNotNull(), F.char_length(text).cast("bigint")).otherwise(F.col(c)).alias(c)
        if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of each group of near duplicates (``NEAR`` % of their five-word shingles).

    All rows of the id that stays, stay; rows without an id are near nothing and stay, as
    do NULL and empty texts. Texts of any length are compared whole, and an empty table
    stays empty.
    """
    return minhash.dedup_documents(docs, percent=NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for: floor(rate) times, once more by a hash of the id.

    A NULL source is a source like others. Rows that share an id, or have none, draw alike.
    NULL and empty texts have no size and are taken at their source's rate; the size of
    long ones is that of the whole text. An empty table stays empty.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of 2048 tokens; see ``packing.pack``.

    Every row is packed, also those that repeat an id or have none; NULL and empty texts are
    the closing id alone, long ones are cut in whole sequences. An empty table gives none.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Sketches, robust estimates and a tokenizer are beyond SQL; tests/llm/test_pipeline.py holds the stages
#: against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
