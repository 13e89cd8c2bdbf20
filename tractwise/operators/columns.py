"""Operators that compute columns: no shuffle, any table size, batch or stream
(``dispatch_unpivot`` also joins a dimension)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tractwise.columns import (
    FEATURES, MEASURE, SCENARIO_BASE, SCENARIO_STEPS, SHARE,
)
from tractwise.functions.arithmetic import (
    clamp_at_zero, hash_uniform, row_sum, safe_divide,
)
from tractwise.functions.population import prime_age_raw
from tractwise.session import replicated_if_small


def select_features(df: DataFrame, features: Iterable[str] = FEATURES) -> DataFrame:
    """The model features, in order."""
    return df.select(*features)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """All columns but these; names the table lacks are ignored."""
    return df.drop(*columns)


def replace_last(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Replace ``column`` by ``value`` and move it to the end."""
    return df.select(*[c for c in df.columns if c != column], value.alias(column))


def weighted_exposure(
    df: DataFrame,
    exposures: Iterable[tuple[str, float, str]],
    *,
    total: str,
    total_of: Iterable[str] | None = None,
) -> DataFrame:
    """Add ``output = column * weight`` per (column, weight, output), and the row
    sum of the outputs (in the order of ``total_of``), NULL if any is NULL."""
    exposures = list(exposures)
    parts = {out: F.col(column) * F.lit(weight) for column, weight, out in exposures}
    return df.withColumns(parts).withColumn(total, row_sum(total_of or parts))


def dispatch_measure(
    df: DataFrame, *, key: str, mapping: Mapping[str, str], factor: str, output: str
) -> DataFrame:
    """Add ``output``: the column ``mapping`` names for the row's ``key``, times
    ``factor``. Keys without an entry give NULL."""
    chosen = None
    for label, column in mapping.items():
        value = F.col(column) * F.col(factor)
        hit = F.col(key) == label
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return df.withColumn(output, chosen)


def dispatch_unpivot(
    df: DataFrame,
    dim: DataFrame,
    *,
    key: str,
    mapping: Mapping[str, str],
    factor: str,
    output: str,
    keep: Iterable[str],
) -> DataFrame:
    """``dispatch_measure`` without the product of both tables: one row per
    mapped column, joined to ``dim`` on its label. Labels of ``dim`` without a
    column have no rows here, so use it only where those are not wanted."""
    keep = list(keep)
    pairs = F.array(*[
        F.struct(F.lit(label).alias(key), F.col(column).cast("double").alias("__value"))
        for label, column in mapping.items()
    ])
    long = df.select(*keep, F.explode(pairs).alias("__pair")).select(*keep, "__pair.*")
    joined = long.join(replicated_if_small(dim.select(key, factor)), key, "inner")
    return joined.select(*keep, key, factor, (F.col("__value") * F.col(factor)).alias(output))


def derived_population(
    df: DataFrame,
    *,
    raw: Column | None = None,
    total: str = "total_pop",
    count: str = MEASURE,
    share: str = SHARE,
) -> DataFrame:
    """Add the clamped count and its share of ``total`` (a fraction).

    ``raw`` is projected once and read by both results.
    """
    return (
        df.withColumn("__raw", prime_age_raw() if raw is None else raw)
        .withColumn("__share", safe_divide("__raw", total))
        .withColumns({count: clamp_at_zero("__raw"), share: clamp_at_zero("__share")})
        .drop("__raw", "__share")
    )


def scenario_grid(
    df: DataFrame,
    column: str,
    *,
    base: float = SCENARIO_BASE,
    steps: int = SCENARIO_STEPS,
    step: str | None = None,
) -> DataFrame:
    """Every row once per step j = 0 .. steps-1 with ``column * base ** j``, the
    column moved last. ``step`` also keeps j under that name."""
    kept = [c for c in df.columns if c != column]
    grid = df.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    named = [F.col("__j").alias(step)] if step else []
    return grid.select(
        *kept, *named, (F.col(column) * F.pow(F.lit(base), F.col("__j"))).alias(column)
    )


def random_amount(
    df: DataFrame, output: str, *, scale: float = 100.0, keys: Iterable[str] = (), seed: int = 0
) -> DataFrame:
    """Add a uniform number in [0, scale).

    With ``keys`` that identify the row it is a hash of them and repeats exactly
    after a lost executor; without, it is ``rand``, which does not.
    """
    keys = list(keys)
    unit = hash_uniform(*keys, seed=seed) if keys else F.rand(seed)
    return df.withColumn(output, unit * scale)
