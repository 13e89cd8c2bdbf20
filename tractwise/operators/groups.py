"""Group maxima and top rows per group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from tractwise.session import REPLICATE_BYTES, checkpointed, fits_in_tasks, replicated_if_small


def _names(columns: str | Iterable[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def group_max(df: DataFrame, group: str | Iterable[str], measure: str) -> DataFrame:
    """Largest ``measure`` per group; groups with only NULLs have none and vanish."""
    return (
        df.where(F.col(measure).isNotNull())
        .groupBy(*_names(group))
        .agg(F.max(measure).alias(measure))
    )


def argmax_rows(
    df: DataFrame, group: str | Iterable[str], measure: str, *, max_bytes: int = REPLICATE_BYTES,
    rows_per_task: int = 200_000,
) -> DataFrame:
    """All rows that hold their group's largest ``measure``, every tie included.

    The maxima are aggregated map-side, stored in the shared folder and measured.
    Small maxima are broadcast and the rows are filtered where they are read,
    so a group that is one big tie never meets in one task. Larger maxima are
    joined by shuffle on (group, measure, salt): the maximum of a group of many rows is
    copied to one salt per ``rows_per_task`` of them, and its rows are dealt over the salts.
    Which groups those are is few rows, at most one in ``rows_per_task``.
    """
    group = _names(group)
    keys = [f"__group{i}" for i in range(len(group))]
    named = [F.col(g).alias(k) for g, k in zip(group, keys)]
    best = checkpointed(
        df.where(F.col(measure).isNotNull()).groupBy(*named)
        .agg(F.max(measure).alias("__best"), F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("__salts"))
    )

    def match(suffix: str = ""):
        same = F.lit(True)
        for g, k in zip(group, keys):
            same = same & (F.col(g) == F.col(k + suffix))
        return same

    top = F.col(measure) == F.col("__best")
    if fits_in_tasks(best, max_bytes):
        return df.join(F.broadcast(best), top & match(), "inner").drop("__best", "__salts", *keys)
    large = best.where("__salts > 1").select(
        *[F.col(k).alias(f"{k}_large") for k in keys], F.col("__salts").alias("__parts"))
    # any deal will do: each salt has a copy of the maximum
    dealt = df.join(replicated_if_small(large), match("_large"), "left").withColumn(
        "__salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("__parts", F.lit(1))))
    copies = best.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
    joined = dealt.join(copies.hint("merge"), top & match() & (F.col("__salt") == F.col("__copy")), "inner")
    return joined.select(*df.columns)


def top_k_rows(
    df: DataFrame,
    group: str | Iterable[str],
    measure: str,
    k: int,
    *,
    tie_break: str | Iterable[str],
    rank: str | None = None,
    unique: bool = False,
    salts: int | None = None,
    max_bytes: int = REPLICATE_BYTES,
) -> DataFrame:
    """The ``k`` rows with the largest ``measure`` per group, ties by ``tie_break``.

    ``unique`` expects that ``tie_break`` identifies a row. Then only the ranking
    columns are sorted, and the rows found are picked from the wide table where
    they are read.

    Spark ranks within each task first (WindowGroupLimit), so a task receives at
    most k rows of a group from each task before it. It does so only for a k
    below a planner setting; from there on groups are first cut to k rows per
    salt (as many salts as shuffle partitions), which keeps every row that can
    be among the first k.
    """
    group, tie_break = _names(group), _names(tie_break)
    order = [F.col(measure).desc_nulls_last(), *[F.col(c).asc() for c in tie_break]]
    name = rank or "__rank"

    def first_k(rows: DataFrame, by: list) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn(name, place).where(F.col(name) <= k)

    ranked = df
    if unique:
        ranked = df.select(*dict.fromkeys([*group, *tie_break, measure]))
    conf = df.sparkSession.conf
    if k >= int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        salts = salts or int(conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.xxhash64(*tie_break), F.lit(salts)).alias("__salt")
        ranked = first_k(ranked.select("*", salt), [*group, "__salt"]).drop("__salt", name)
    top = first_k(ranked, group)
    if unique:
        keys = list(dict.fromkeys([*group, *tie_break]))
        found = checkpointed(
            top.select(*[F.col(c).alias(f"__key{i}") for i, c in enumerate(keys)]).distinct()
        )
        match = F.lit(True)
        for i, c in enumerate(keys):
            match = match & F.col(c).eqNullSafe(F.col(f"__key{i}"))
        picked = df.join(replicated_if_small(found, max_bytes), match, "inner").drop(
            *[f"__key{i}" for i in range(len(keys))]
        )
        # an id that occurs twice was found once: rank the few rows picked
        top = first_k(picked, group)
    return top if rank else top.drop(name)
