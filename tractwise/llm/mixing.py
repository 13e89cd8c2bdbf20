"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tractwise.llm.tables import Stored
from tractwise.session import replicated_if_small

WORDS = r"[^\x20\x09-\x0D]+"
#: Draws are the first 13 hexadecimal digits of an MD5, which a double holds exactly.
DIGITS = 13


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint").cast("double") / F.lit(
        float(16**DIGITS)
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float], max_repeat: float, stored: Stored
) -> DataFrame:
    """What each source is to give: ``mix_source``, ``source_size``, ``target``.

    Reads ``mix_source`` and ``size``. Sources, in code point order with NULL last,
    take the weights in turn. All targets add up to all sizes; one stops at
    ``max_repeat`` times its source and the excess goes to the others by weight, as
    often as needed. This works on one row per source: their numbering is the one step
    in a single task, and the rounds exchange one row of sums with the driver.
    """
    size = F.coalesce(F.sum("size"), F.lit(0)).cast("bigint")
    totals = sizes.groupBy("mix_source").agg(size.alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    table = stored(totals.withColumn("weight", weight))
    limit = F.col("source_size") * F.lit(float(max_repeat))
    level, full, settled = 0.0, F.lit(False), -1
    while True:
        # every source above its limit at the level so far stays there
        free = table.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if free["weight"] <= 0 or free["n"] == settled:
            break
        settled = free["n"]
        level = max(level, (free["all"] - free["full"]) / free["weight"])
        full = F.col("weight") * F.lit(level) >= limit
    target = F.least(limit, F.col("weight") * F.lit(level))
    return table.select("mix_source", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    max_repeat: int = 3,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Every row of ``docs`` with how often the mix takes it.

    Adds ``mix_size`` (words, 0 for NULL), ``mix_source_size``, ``mix_target``,
    ``mix_rate`` and ``mix_copies``: a row is taken floor(rate) times and once more if
    the hash of its id and the seed falls below the fraction, so reruns and repeated
    tasks agree. Sources are joined NULL-safe. Rows that repeat an id share its draw.
    A source without words has rate 0. An empty table gives an empty result. Columns of
    these names are replaced; all others stay as they are.
    """
    added = ("mix_size", "mix_source_size", "mix_target", "mix_rate", "mix_copies")
    docs = docs.drop(*added)
    stored = Stored(docs.sparkSession)
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORDS)), F.lit(0)).cast("bigint")
    sizes = docs.select(F.col(source_column).alias("mix_source"), size.alias("size"))
    targets = stored(source_targets(sizes, weights, max_repeat, stored))
    rate = F.when(
        F.col("source_size") > 0,
        F.least(F.lit(float(max_repeat)), F.col("target") / F.col("source_size")),
    ).otherwise(0.0)
    rates = targets.select(
        F.col("mix_source").alias("__source"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), rate.alias("mix_rate"),
    )
    extra = draw(F.col(id_column), seed) < F.col("mix_rate") - F.floor("mix_rate")
    return (
        docs.withColumn("mix_size", size)
        .join(replicated_if_small(rates), F.col(source_column).eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("mix_copies", (F.floor("mix_rate") + extra.cast("int")).cast("int"))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: each row of ``docs``, with its own columns, as often as it is taken."""
    names = docs.columns
    plan = mix_plan(docs, **options)
    copies = F.explode(F.sequence(F.lit(1), F.col("mix_copies")))
    return plan.where("mix_copies > 0").select(*[F.col(f"`{c}`") for c in names], copies.alias("__n")).drop("__n")
