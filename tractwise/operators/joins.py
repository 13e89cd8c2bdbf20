"""Joins.

Joins on area ids shuffle both sides, with AQE splitting skewed partitions. Those of
vintages and those that add columns say so by a hint: of a side with generated rows, outlines
or outputs of a Python function Spark knows no size, only a guess from its files, and by that
guess would bring it whole to the driver to broadcast it. Joins on a key of few values broadcast the
small side once it has been measured.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tractwise.session import REPLICATE_BYTES, fits_in_tasks, measured_bytes, replicated_if_small

#: The size of a block of rows where a product is joined block by block.
BLOCK_BYTES = 64 * 1024 * 1024


def period_diff(
    current: DataFrame,
    previous: DataFrame,
    *,
    key: str,
    measure: str,
    labels: tuple[str, str],
) -> DataFrame:
    """Change of ``measure`` between two vintages, for keys that have it in both.

    A change is NULL exactly when one measure is, so NULLs are filtered at the
    scans and never shuffled. Neither vintage is broadcast.
    """
    now, before = (f"{measure}_{label}" for label in labels)

    def vintage(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(measure).isNotNull()).select(key, F.col(measure).alias(name))

    joined = vintage(current, now).join(vintage(previous, before).hint("merge"), key, "inner")
    change = F.col(now) - F.col(before)
    return joined.select(key, now, before, change.alias(f"{measure}_diff"))


def cast_key_join(
    left: DataFrame, right: DataFrame, *, left_key: str, right_key: str, keep: Iterable[str]
) -> DataFrame:
    """Inner join on the keys' text, adding the ``keep`` columns of ``right``. Neither side
    is broadcast, whatever Spark guesses their sizes to be."""
    text = right.select(F.col(right_key).cast("string").alias("__key"), *keep)
    joined = left.join(
        text.hint("merge"), F.col(left_key).cast("string") == F.col("__key"), "inner"
    )
    return joined.drop("__key")


def prefix_join(
    df: DataFrame,
    prefixes: DataFrame,
    *,
    column: str,
    prefix: str,
    keep: Iterable[str],
    length: int | None = None,
    max_bytes: int = REPLICATE_BYTES,
) -> DataFrame:
    """Every row with every prefix its ``column`` starts with, as an equi-join.

    A join on ``startswith`` has no key to hash and compares all pairs. Here
    each row gets one candidate per prefix length that occurs (a scalar
    subquery) and is joined on equality. With ``length`` all prefixes must have
    that length; then the key is plain and no row is multiplied. A prefix that
    breaks the promise fails the job rather than losing rows.
    """
    side = replicated_if_small(
        prefixes.select(F.col(prefix).alias("__prefix"), *keep), max_bytes
    )
    if length is not None:
        right_length = F.col("__prefix").isNull() | (F.length("__prefix") == length)
        side = side.withColumn(
            "__prefix",
            F.when(right_length, F.col("__prefix")).otherwise(
                F.raise_error(F.concat(F.lit(f"prefix not of length {length}: "), "__prefix"))
            ),
        )
        return df.join(side, F.left(column, F.lit(length)) == F.col("__prefix")).drop("__prefix")
    lengths = prefixes.select(F.collect_set(F.length(prefix))).scalar()
    candidates = (
        df.withColumn("__length", F.explode(lengths))
        .where(F.length(column) >= F.col("__length"))
        .withColumn("__start", F.left(column, F.col("__length")))
    )
    joined = candidates.join(side, F.col("__start") == F.col("__prefix"), "inner")
    return joined.drop("__length", "__start", "__prefix")


def cross_dimension(
    df: DataFrame,
    dim: DataFrame,
    *,
    max_bytes: int = REPLICATE_BYTES,
    blocks: int | None = None,
) -> DataFrame:
    """Every row of ``df`` with every row of ``dim``; ``dim`` columns come first.

    A ``dim`` measured at ``max_bytes`` or less goes to the tasks as one array
    and is exploded next to each row: no shuffle. A larger one is joined block
    by block: rows of ``df`` are dealt over ``blocks``, by default as many as keep a
    block of ``df`` near ``BLOCK_BYTES``, ``dim`` is copied to each block, and the
    block number is the join key. The merge hint keeps Spark from
    broadcasting the copies, whose number its size estimate does not see.
    """
    if fits_in_tasks(dim, max_bytes):
        members = dim.select(F.collect_list(F.struct(*dim.columns))).scalar()
        return df.withColumn("__dim", F.explode(members)).select("__dim.*", *df.columns)
    blocks = blocks or max(1, -(-measured_bytes(df) // BLOCK_BYTES))
    # as JSON, since maps have no hash
    block = F.pmod(F.xxhash64(F.to_json(F.struct(*df.columns))), F.lit(blocks)).cast("int")
    dealt = df.withColumn("__block", block)
    copies = dim.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return dealt.join(copies.hint("merge"), "__block").select(*dim.columns, *df.columns)


def restrict_to(df: DataFrame, members: DataFrame, on: str, *, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key occurs in ``members``.

    ``how="inner"`` repeats a row once per occurrence, as a plain join would.
    """
    if how not in ("left_semi", "inner"):
        raise ValueError(f"how must be left_semi or inner, not {how!r}")
    side = members.select(F.col(on).alias("__member"))
    return df.join(side, F.col(on) == F.col("__member"), how).drop("__member")


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(DataFrame.unionByName, parts)
