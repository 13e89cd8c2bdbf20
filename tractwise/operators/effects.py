"""Least squares with an effect per category, for categories of any number of values."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tractwise.operators.models import PREDICTION, known_number
from tractwise.session import replicated_if_small, scratch_path

#: A number whose variation within the categories is less than this part of all of it is explained by them.
ABSORBED = 1e-18


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "effects")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matched(rows: DataFrame, category: str, table: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """``rows`` with columns of ``table`` (by its ``value``) under the names of ``values``; a NULL category has a row of its own.

    The table is broadcast once it is measured small; beyond that the rows of a frequent
    category are divided by the planner's skew handling, as the table has one row for it.
    """
    side = table.select(F.col("value").alias("__value"), *[F.col(c).alias(name) for name, c in values.items()])
    return rows.join(replicated_if_small(side), F.col(category).eqNullSafe(F.col("__value")), "left").drop("__value")


@dataclass
class AbsorbedModel:
    """Coefficients of the numbers and, for each category, a table of its values' effects.

    A tables' columns are ``value``, ``rows`` and ``effect``. NULL is a value like others;
    a value without an effect counts as the average row. Missing numbers count as their
    training mean, in ``means``.
    """

    coefficients: dict[str, float]
    means: dict[str, float]
    effects: dict[str, DataFrame]
    averages: dict[str, float]
    sweeps: int = 0
    prediction: str = field(default=PREDICTION)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the prediction: all its rows and columns stay."""
        total: Column = F.lit(0.0)
        for name, weight in self.coefficients.items():
            total = total + F.lit(weight) * F.coalesce(known_number(name), F.lit(self.means[name]))
        rows = df
        for i, (category, table) in enumerate(self.effects.items()):
            rows = _matched(rows, category, table, {f"__effect_{i}": "effect"})
            total = total + F.coalesce(F.col(f"__effect_{i}"), F.lit(self.averages[category]))
        kept = [F.col(f"`{c}`") for c in df.columns if c != self.prediction]
        return rows.select(*kept, total.alias(self.prediction))

    def save(self, root: str, name: str) -> str:
        path = f"{root.rstrip('/')}/{name}"
        spark = None
        for i, table in enumerate(self.effects.values()):
            spark = table.sparkSession
            table.write.mode("overwrite").parquet(f"{path}/effects_{i}")
        about = {"coefficients": self.coefficients, "means": self.means, "categories": list(self.effects),
                 "averages": self.averages, "sweeps": self.sweeps, "prediction": self.prediction}
        spark = spark or SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
        return path


def load_absorbed(spark: SparkSession, root: str, name: str) -> AbsorbedModel:
    path = f"{root.rstrip('/')}/{name}"
    about = json.loads(spark.read.parquet(f"{path}/about").first().about)
    effects = {c: spark.read.parquet(f"{path}/effects_{i}") for i, c in enumerate(about.pop("categories"))}
    return AbsorbedModel(effects=effects, **about)


def _swept(cells: DataFrame, categories: Sequence[str], numbers: Sequence[str], tolerance: float, most: int):
    """Effects of each category on each of ``numbers``, by turns: those of one category are the means of what
    the others leave. Works on sums per combination of categories, and stops when no mean moves
    by ``tolerance`` of the numbers' spread. One category needs one turn."""
    tables: dict[str, DataFrame] = {}
    sweeps = 0
    while True:
        moved = 0.0
        for category in categories:
            left = cells
            for i, (other, table) in enumerate(tables.items()):
                if other != category:
                    left = _matched(left, other, table, {f"__{n}_{i}": n for n in numbers})
                    left = left.withColumns({n: F.col(n) - F.col("n") * F.col(f"__{n}_{i}") for n in numbers})
            means = left.groupBy(F.col(category).alias("value")).agg(
                F.sum("n").alias("rows"), *[(F.sum(n) / F.sum("n")).alias(n) for n in numbers])
            new = _stored(means)
            if category in tables and len(categories) > 1:
                both = new.join(tables[category].select(
                    F.col("value").alias("__value"), *[F.col(n).alias(f"__{n}") for n in numbers]),
                    F.col("value").eqNullSafe(F.col("__value")))
                gap = F.greatest(F.lit(0.0), *[F.abs(F.col(n) - F.col(f"__{n}")) for n in numbers])
                moved = max(moved, both.agg(F.coalesce(F.max(gap), F.lit(0.0))).first()[0])
            else:
                moved = max(moved, 0.0 if len(categories) == 1 else float("inf"))
            tables[category] = new
        sweeps += 1
        if moved <= tolerance:
            return tables, sweeps
        if sweeps >= most:
            raise ValueError(f"the effects still move by {moved} after {sweeps} turns: the categories are nearly the same")


def fit_absorbed(
    df: DataFrame, *, label: str, numeric: Sequence[str], categorical: Sequence[str], prediction: str = PREDICTION,
    tolerance: float = 1e-11, most_sweeps: int = 500,
) -> AbsorbedModel:
    """The same fit as indicators for all values of ``categorical``, without a list of the values anywhere.

    The effects are taken out of the label and the numbers (with several categories by
    turns), least squares of what is left gives the coefficients, and the effects follow
    from them. What is shuffled are sums per combination of categories, added up in each
    task before; the driver holds coefficients and means.

    A number that does not vary within the categories, like any with one row per
    category, is explained by them: its coefficient is 0. Rows without a label are left
    out; NULL, NaN and infinite numbers count as the mean. No labelled row fails.
    """
    categorical, numeric = list(categorical), list(numeric)
    if not categorical:
        raise ValueError("needs a category; use fit_linear")
    y = F.col(label).cast("double")
    rows = df.where(y.isNotNull() & ~F.isnan(y)).select(
        *categorical, y.alias("__y"), *[known_number(c).alias(f"__x{i}") for i, c in enumerate(numeric)])
    numbers = ["__y", *[f"__x{i}" for i in range(len(numeric))]]
    stats = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in numbers],
                     *[F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias(f"{c}_spread") for c in numbers]).first()
    if not stats.n:
        raise ValueError("no row has a label")
    known = [c for c in numbers if stats[c] is not None]
    # in units of their spread, so that one tolerance serves all
    unit = {c: stats[f"{c}_spread"] or 1.0 for c in known}
    scaled = _stored(rows.select(*categorical, *[
        ((F.coalesce(c, F.lit(stats[c])) - F.lit(stats[c])) / F.lit(unit[c])).alias(c) for c in known]))
    cells = scaled.groupBy(*categorical).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in known])
    cells = _stored(cells) if len(categorical) > 1 else cells
    tables, sweeps = _swept(cells, categorical, known, tolerance, most_sweeps)

    left = scaled
    for i, (category, table) in enumerate(tables.items()):
        left = _matched(left, category, table, {f"__{c}_{i}": c for c in known})
        left = left.withColumns({c: F.col(c) - F.col(f"__{c}_{i}") for c in known}).select(*categorical, *known)
    left = _stored(left.select(*known))
    inputs = [c for c in known if c != "__y"]
    squares = left.agg(F.count(F.lit(1)), *[F.sum(F.col(c) * F.col(c)).alias(c) for c in inputs]).first()
    inputs = [c for c in inputs if squares[c] > ABSORBED * stats.n]
    weights = dict.fromkeys([c for c in known if c != "__y"], 0.0)
    if inputs:
        vectors = VectorAssembler(inputCols=inputs, outputCol="__features").transform(left)
        fit = LinearRegression(featuresCol="__features", labelCol="__y", fitIntercept=False, solver="normal").fit(vectors)
        weights |= dict(zip(inputs, map(float, fit.coefficients)))
    names = {f"__x{i}": c for i, c in enumerate(numeric)}
    # the effects of what the numbers leave of the label, in its own unit; the first ones hold the level
    coefficients = {names[c]: w * unit["__y"] / unit[c] for c, w in weights.items()}
    level = stats["__y"] - sum(coefficients[names[c]] * stats[c] for c in weights)
    effects, averages = {}, {}
    for i, (category, table) in enumerate(tables.items()):
        effect = F.col("__y") - sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.lit(0.0))
        effect = effect * F.lit(unit["__y"]) + F.lit(level if i == 0 else 0.0)
        effects[category] = _stored(table.select("value", "rows", effect.alias("effect")))
        averages[category] = effects[category].agg(F.sum(F.col("rows") * F.col("effect")) / F.sum("rows")).first()[0]
    means = {names[c]: stats[c] for c in weights}
    return AbsorbedModel(coefficients, means, effects, averages, sweeps, prediction)
