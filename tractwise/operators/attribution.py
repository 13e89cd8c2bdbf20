"""Per-row feature attributions, and the tables made of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from tractwise.operators.models import FILLED, PREDICTION, known_number

STRUCT = "feature_importance"


def training_baseline(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), label: str | None = None
) -> dict[str, float | str | None]:
    """The row attributions are measured against, by the numbers and the rows a model
    with this ``label`` is fitted to: mean of each number (NULL, NaN and infinity aside),
    most frequent value of each category (ties: the smallest). One row of values."""
    if label is not None:
        df = df.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
    row = df.agg(*[F.avg(known_number(c)).alias(c) for c in numeric]).first() if numeric else None
    baseline = {c: row[c] for c in numeric}
    for c in categorical:
        common = (
            df.where(F.col(c).isNotNull()).groupBy(c).count()
            .orderBy(F.desc("count"), F.asc(c)).first()
        )
        baseline[c] = common[0] if common else None
    return baseline


def linear_attributions(
    df: DataFrame, model: PipelineModel, *, baseline: Mapping[str, float], keys: Sequence[str]
) -> DataFrame:
    """``keys`` and the struct of ``coefficient * (value - baseline)`` per feature.

    Exact for a linear model of numeric features, and a projection. A NULL value
    counts as the number the model filled in for it.
    """
    *prepare, assembler, regression = model.stages
    inputs = assembler.getInputCols()
    if not isinstance(regression, LinearRegressionModel) or not all(
        c.startswith(FILLED) for c in inputs
    ):
        raise ValueError("needs a linear model of numeric features; use sampled_attributions")
    terms = []
    for column, weight in zip(inputs, regression.coefficients):
        name = column.removeprefix(FILLED)
        away = F.col(column) - F.lit(float(baseline[name]))
        terms.append((F.lit(float(weight)) * away).alias(name))
    return PipelineModel(stages=prepare).transform(df).select(*keys, F.struct(*terms).alias(STRUCT))


def sampled_attributions(
    df: DataFrame,
    model: PipelineModel,
    *,
    baseline: Mapping[str, float | str | None],
    features: Sequence[str],
    keys: Sequence[str],
    permutations: int = 16,
    seed: int = 0,
) -> DataFrame:
    """``keys`` and the struct of sampled Shapley values for any model. Keys that
    do not identify a row fail the job.

    Each row is scored along ``permutations`` orders of its features: features
    before the current step have the row's value, the others the baseline's. A
    feature is credited with the change at its own step. Every scored point
    therefore adds to the feature set last and subtracts from the one set next,
    which needs no ordering of points: one partial sum per key and task is all
    that is shuffled. Orders are hashes of the key, so they repeat exactly.
    The values of a row sum to prediction minus prediction at the baseline.
    """
    features = list(features)
    count = len(features)
    shuffled = F.sort_array(F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.struct(F.xxhash64(F.lit(seed), *keys, F.col("__round"), i).alias("h"), i.alias("i")),
    ))
    points = (
        df.select(*keys, *[F.col(c).alias(f"__own_{i}") for i, c in enumerate(features)])
        .withColumn("__round", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumn("__order", F.transform(shuffled, lambda s: s["i"]))
        # found once per order, so a step only compares: quadratic in the features, not cubic
        .withColumn("__place", F.transform(
            F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.array_position("__order", i)))
        .withColumn("__step", F.explode(F.sequence(F.lit(0), F.lit(count))))
    )

    types = {field.name: field.dataType for field in df.schema}

    def masked(i: int, name: str) -> Column:
        absent = F.lit(baseline[name]).cast(types[name])
        present = F.expr(f"get(__place, {i}) <= __step")
        return F.when(present, F.col(f"__own_{i}")).otherwise(absent).alias(name)

    key_names = [f"__key_{i}" for i in range(len(keys))]
    scored = model.transform(points.select(
        *[F.col(k).alias(n) for k, n in zip(keys, key_names)],
        F.expr("get(__order, __step - 1) as __gains"),
        F.expr("get(__order, __step) as __loses"),
        F.expr("__round = 1 and __step = 0 as __first"),
        *[masked(i, name) for i, name in enumerate(features)],
    ))
    credit = [
        F.expr(
            f"sum(case when __gains = {i} then {PREDICTION}"
            f" when __loses = {i} then -{PREDICTION} else 0D end) / {permutations}"
        ).alias(name)
        for i, name in enumerate(features)
    ]
    summed = scored.groupBy(*key_names).agg(*credit, F.count_if("__first").alias("__rows"))
    unique = F.when(F.col("__rows") == 1, F.struct(*features)).otherwise(
        F.raise_error(F.lit(f"{list(keys)} do not identify a row"))
    )
    return summed.select(
        *[F.col(n).alias(k) for k, n in zip(keys, key_names)], unique.alias(STRUCT)
    )


def expand_struct(df: DataFrame, struct: str, *keep: str | Column) -> DataFrame:
    """``keep`` and one column per field of ``struct``."""
    return df.select(*keep, f"{struct}.*")


def attribution_table(
    predictions: DataFrame, *, group: str = "state", row: str = "geo_id", struct: str = STRUCT
) -> DataFrame:
    """``state_code``, ``tract`` and one column per feature, ready to be written by
    group. The group has a name of its own because ``state`` is a feature too."""
    return expand_struct(
        predictions, struct, F.col(group).alias("state_code"), F.col(row).alias("tract")
    )


def attributions_long(
    table: DataFrame, *, keys: Sequence[str] = ("state_code", "tract")
) -> DataFrame:
    """One row per table row and feature: keys, ``feature``, ``importance``."""
    features = [c for c in table.columns if c not in keys]
    return table.unpivot(list(keys), features, "feature", "importance")


def rank_attributions(
    table: DataFrame, *, keys: Sequence[str] = ("state_code", "tract")
) -> DataFrame:
    """Keys, ``feature``, ``importance``, ``abs_value`` and ``rank``, the largest
    absolute value first. A row holds all its features, so they are sorted inside
    the row and nothing is shuffled."""
    entries = F.array(*[
        F.struct(
            F.col(c).isNull().alias("missing"), (-F.abs(c)).alias("order"),
            F.lit(c).alias("feature"), F.col(c).alias("importance"),
        )
        for c in table.columns if c not in keys
    ])
    return table.select(*keys, F.posexplode(F.sort_array(entries)).alias("__at", "__entry")).select(
        *keys, "__entry.feature", "__entry.importance",
        F.abs("__entry.importance").alias("abs_value"), (F.col("__at") + 1).alias("rank"),
    )


def transpose_attributions(
    table: DataFrame, *, group: str = "state_code", row: str = "tract", slots: int = 2
) -> DataFrame:
    """One row per group and feature, with columns ``tract_1 .. tract_n``.

    The rows of a group become columns in the order of their ids. Every row is
    turned: a group of more than ``slots`` rows fails the job. ``top_k_rows`` makes
    the choice of rows, ``attributions_long`` takes any number.
    """
    window = Window.partitionBy(group).orderBy(F.asc(row))
    place = F.row_number().over(window)
    numbered = table.withColumn("__slot", F.when(place <= slots, place).otherwise(
        F.raise_error(F.lit(f"a group has more than {slots} rows to turn into columns")).cast("int")))
    wide = (
        attributions_long(numbered.drop(row), keys=(group, "__slot"))
        .groupBy(group, "feature")
        .pivot("__slot", list(range(1, slots + 1)))
        .agg(F.first("importance"))
    )
    return wide.select(
        group, "feature", *[F.col(str(n)).alias(f"{row}_{n}") for n in range(1, slots + 1)]
    )


def rank_attributions_wide(
    wide: DataFrame, *, group: str = "state_code", first: str = "tract_1"
) -> DataFrame:
    """Add ``rank`` by the absolute value of the first column, per group. A
    group has one row per feature here."""
    window = Window.partitionBy(group).orderBy(F.abs(first).desc_nulls_last(), F.asc("feature"))
    return wide.withColumn("rank", F.row_number().over(window))
