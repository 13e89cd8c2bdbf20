"""Chat formatting: a dialogue from the perspective of each of its speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Turns of a dialogue that are summed up together, before the sums are.
SPAN = 128
#: Marks around a segment, and the role of instructions, which belong to no speaker.
OPEN, CLOSE, SYSTEM, NOBODY = "<|im_start|>", "<|im_end|>", "system", "unknown"


def rotate_perspectives(
    turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Every dialogue once per speaker, with that speaker as the assistant.

    One row per perspective and turn: ``conv_id``, ``perspective``, ``turn``, ``place``
    (from 0), ``speaker``, ``segment``, ``mask``, ``mask_start``, ``mask_end``,
    ``start``, ``end``. The rendered dialogue is the segments by ``place``; ``start``
    and ``end`` are a segment's characters in it, and ``mask`` tells whether the text
    from ``mask_start`` to ``mask_end``, closing mark included, is the assistant's, to
    be trained on (NULL bounds else). The speaker is rendered as ``assistant``, others
    as ``user name=...``, system turns as they are.

    Speakers are the roles that occur but ``system``; a NULL role is the speaker
    ``unknown``, a NULL text is empty. Turns are ordered by number (NULL first), then
    role and text, so ties and repeated rows, which all stay, render alike on each run.
    A NULL id is a dialogue too. A dialogue of system turns alone has no perspective.

    A turn is rendered once per speaker and joined to nobody else's. Places and starts
    are running sums in two levels: within spans of ``SPAN`` turn numbers and over the
    spans' sums, so a task holds a span or the sums of a dialogue, not all its texts.
    """
    rows = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(NOBODY)).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("span", F.floor(F.col("turn") / SPAN))
    speakers = rows.where(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective")).distinct()
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    mine = F.col("speaker") == F.col("perspective")
    head = F.concat(
        F.lit(OPEN), F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM)).when(mine, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), F.col("speaker"))), F.lit("\n"))
    rendered = seen.withColumns({
        "mask": mine, "head": F.char_length(head),
        "segment": F.concat(head, F.col("text"), F.lit(CLOSE + "\n")),
    }).withColumn("size", F.char_length("segment").cast("bigint"))
    keys = ["conv_id", "perspective"]
    sums = rendered.groupBy(*keys, "span").agg(F.sum("size").alias("chars"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("span")).rowsBetween(
        Window.unboundedPreceding, -1)
    before = sums.select(
        *[F.col(c).alias(f"__{c}") for c in (*keys, "span")],
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"))
    order = Window.partitionBy(*keys, "span").orderBy(F.asc_nulls_first("turn"), "speaker", "text")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*keys, "span")]
    placed = rendered.withColumns({
        "place": F.row_number().over(order) - 1, "upto": F.sum("size").over(running),
    }).join(before, same)
    end = F.col("chars_before") + F.col("upto")
    start = end - F.col("size")
    return placed.select(
        "conv_id", "perspective", "turn", (F.col("n_before") + F.col("place")).cast("bigint").alias("place"),
        "speaker", "segment", "mask",
        F.when(F.col("mask"), start + F.col("head")).cast("bigint").alias("mask_start"),
        F.when(F.col("mask"), end - 1).cast("bigint").alias("mask_end"),
        start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))


def dialogues(rotated: DataFrame) -> DataFrame:
    """Rendered dialogues, one row each, of segments that fit in one: ``conv_id``,
    ``perspective``, ``text`` and ``masks``, the ranges of characters to train on."""
    every = F.sort_array(F.collect_list(F.struct("place", "segment", "mask", "mask_start", "mask_end")))
    whole = rotated.groupBy("conv_id", "perspective").agg(every.alias("all"))
    return whole.select(
        "conv_id", "perspective", F.array_join(F.transform("all", lambda s: s["segment"]), "").alias("text"),
        F.transform(F.filter("all", lambda s: s["mask"]), lambda s: F.struct(
            s["mask_start"].alias("start"), s["mask_end"].alias("end"))).alias("masks"))
