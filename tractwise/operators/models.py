"""Regression models over tables: fit, apply, compare, store.

Fitting aggregates over executors and only moves model-sized data; applying a
model is a projection.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tractwise.columns import GRADUATES, MEASURE, SHARE
from tractwise.functions.arithmetic import hash_uniform, round_int, safe_divide
from tractwise.operators.histogram_trees import HistogramTrees
from tractwise.session import scratch_path, shared_dir
from tractwise.sources.versions import current_path, publish_folder

PREDICTION = "predicted_label"
VECTOR = "__features"
FILLED = "__filled_"

#: Bins of the default trees; more are taken where a category has more values.
MAX_BINS = 128

#: Rows from which trees are grown from stored blocks of bins; MLlib, faster on fewer rows, keeps all of them as objects.
MANY_ROWS = 2_000_000

#: Stored vectors take in files what they hold: the trees keep in memory what a task reads, and as
#: encoded values, few of which differ, a hundred times as many rows would be read by one.
PLAIN_FILES = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20)}


#: A number, or NULL where it is NaN or infinite.
KNOWN = ("case when abs(cast(`{0}` as double)) < double('infinity') and not isnan(cast(`{0}` as double))"
         " then cast(`{0}` as double) end")


def known_number(column: str) -> Column:
    return F.expr(KNOWN.format(column))


def _numeric_stages(rows: DataFrame, numeric: Sequence[str]) -> tuple[list, list[str]]:
    """A stage that gives NULL, NaN and infinity the training mean, all means in one pass.
    A column without any value tells nothing and is left out of the model."""
    if not numeric:
        return [], []
    known = {c: KNOWN.format(c) for c in numeric}
    means = rows.agg(*[F.avg(known_number(c)).alias(c) for c in numeric]).first()
    filled = {
        f"{FILLED}{c}": f"coalesce({value}, {means[c]!r}D)"
        for c, value in known.items() if means[c] is not None
    }
    fields = ", ".join(["*", *[f"{value} AS `{name}`" for name, value in filled.items()]])
    return [SQLTransformer(statement=f"SELECT {fields} FROM __THIS__")], list(filled)


def _index_stages(categorical: Sequence[str]) -> tuple[list, list[str]]:
    """Unseen or NULL categories become a category of their own."""
    indexed = [f"__index_{c}" for c in categorical]
    if not categorical:
        return [], []
    indexer = StringIndexer(
        inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"
    )
    return [indexer], indexed


def _one_hot_stages(rows: DataFrame, categorical: Sequence[str]) -> tuple[list, list[str]]:
    """Indicators of all categories but one, so that they do not add up to the
    intercept: without NULLs in the training rows the most frequent category has
    none, and unseen ones count as it; with NULLs, NULL has none."""
    if not categorical:
        return [], []
    indexers, indexed = _index_stages(categorical)
    fitted = indexers[0].fit(rows)
    missing = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in categorical]).first()
    hot = [f"__hot_{c}" for c in categorical]
    stages, inputs = [fitted, OneHotEncoder(inputCols=indexed, outputCols=hot)], []
    for c, column, labels in zip(categorical, hot, fitted.labelsArray):
        if missing[c]:
            inputs.append(column)
        elif len(labels) > 1:
            cut = f"__cut_{c}"
            stages.append(
                VectorSlicer(inputCol=column, outputCol=cut, indices=list(range(1, len(labels))))
            )
            inputs.append(cut)
    return stages, inputs


def _labelled(df: DataFrame, label: str, features: Iterable[str]) -> DataFrame:
    return df.select(*features, F.col(label).cast("double").alias("__label")).where(
        F.col("__label").isNotNull()
    )


def fit_linear(
    df: DataFrame,
    *,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    prediction: str = PREDICTION,
) -> PipelineModel:
    """Least squares in one pass over the table (one more per encoding).

    Leave an id with one value per row out of ``categorical``: with a
    coefficient per row the other coefficients are not determined, though such
    a model can be asked for.
    """
    rows = _labelled(df, label, [*numeric, *categorical])
    fill, filled = _numeric_stages(rows, numeric)
    encode, encoded = _one_hot_stages(rows, categorical)
    stages = [*fill, *encode, VectorAssembler(inputCols=[*filled, *encoded], outputCol=VECTOR)]
    regression = LinearRegression(
        featuresCol=VECTOR, labelCol="__label", predictionCol=prediction
    )
    return Pipeline(stages=[*stages, regression]).fit(rows)


def default_candidates() -> list[Estimator]:
    """The regressors ``fit_best`` compares: linear, forest, boosted trees."""
    return [
        LinearRegression(),
        RandomForestRegressor(numTrees=20, maxDepth=5, maxBins=MAX_BINS, seed=7),
        GBTRegressor(maxIter=20, maxDepth=4, maxBins=MAX_BINS, seed=7),
    ]


#: What a candidate's fit takes longer for, and what a search gives it little of at first.
RESOURCES = ("maxIter", "numTrees")


@dataclass
class Trial:
    """One fit of a search: the candidate's place, its regressor, the share of its trees or rounds, and the outcome."""

    candidate: int
    kind: str
    share: float
    rmse: float
    seconds: float


def _with_share(regressor: Estimator, share: float) -> Estimator:
    """The regressor with ``share`` of its trees or boosting rounds; a linear one needs none."""
    for name in RESOURCES:
        if share < 1 and regressor.hasParam(name) and not isinstance(regressor, LinearRegression):
            param = regressor.getParam(name)
            return regressor.copy({param: max(1, math.ceil(regressor.getOrDefault(param) * share))})
    return regressor


def _fitted(regressor: Estimator, rows: DataFrame, trees: HistogramTrees | None) -> Model:
    return trees.fit(regressor) if trees and trees.can_fit(regressor) else regressor.fit(rows)


def search(
    regressors: Sequence[Estimator], training: DataFrame, validation: DataFrame, *, prediction: str = PREDICTION,
    shrink: int = 3, parallelism: int = 4, budget_seconds: float | None = None, trees: HistogramTrees | None = None,
) -> tuple[int, list[Trial]]:
    """The place of the best regressor by validation RMSE, and all trials.

    Up to ``shrink`` candidates are compared by whole fits. More are compared in rounds:
    first with a part of their trees or boosting rounds, then the best of each ``shrink``
    go on with ``shrink`` times as much, until the last ones are fitted whole. Rows are
    never sampled. ``parallelism`` fits run at a time, as jobs of one session; after
    ``budget_seconds`` no further fit begins, and the best of the latest round with a
    result wins. Ties go to the first candidate. ``trees`` fits those regressors it can.
    """
    evaluator = RegressionEvaluator(labelCol="__label", predictionCol=prediction, metricName="rmse")
    began = time.monotonic()

    def in_time() -> bool:
        return budget_seconds is None or time.monotonic() - began < budget_seconds

    def trial(place: int, share: float) -> Trial | None:
        if not in_time() and (place, share) != first:
            return None
        start = time.monotonic()
        model = _fitted(_with_share(regressors[place], share), training, trees)
        rmse = evaluator.evaluate(model.transform(validation))
        return Trial(place, type(regressors[place]).__name__, share, rmse, time.monotonic() - start)

    rounds = 0
    while len(regressors) > shrink ** (rounds + 1):
        rounds += 1
    left, trials, best = list(range(len(regressors))), [], 0
    for step in range(rounds, -1, -1):
        share = float(shrink) ** -step
        first = (left[0], share) if not trials else None  # one fit is made whatever the budget
        with ThreadPoolExecutor(parallelism) as pool:
            results = list(pool.map(inheritable_thread_target(training.sparkSession)(lambda p: trial(p, share)), left))
        done = sorted((t for t in results if t is not None), key=lambda t: (t.rmse, t.candidate))
        trials += done
        if done:
            best = done[0].candidate
        if len(done) < len(left):
            break
        left = sorted(t.candidate for t in done[: math.ceil(len(left) / shrink)])
    return best, trials


def fit_best(
    df: DataFrame,
    *,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    candidates: Sequence[Estimator] | None = None,
    prediction: str = PREDICTION,
    train_ratio: float = 0.8,
    shrink: int = 3,
    parallelism: int = 4,
    budget_seconds: float | None = None,
    trials: list[Trial] | None = None,
    many_rows: int = MANY_ROWS,
) -> PipelineModel:
    """The candidate with the least validation RMSE, fitted again on all rows.

    The budget of the search is the list of candidates and ``budget_seconds``; see
    ``search``, whose trials are added to ``trials``. Features are assembled once into
    stored (label, vector) rows that all fits read. Rows are split by a hash of their
    values, so a recomputed partition splits the same way and copies of a row
    stay on one side. From ``many_rows`` on trees are grown by ``HistogramTrees``, else by
    MLlib; the draws of a forest differ between the two. Boosted trees cut their lineage in
    the shared folder.
    """
    shared_dir(df.sparkSession)
    features = [*numeric, *categorical]
    rows = _labelled(df, label, features)
    fill, filled = _numeric_stages(rows, numeric)
    index, indexed = _index_stages(categorical)
    assemble = VectorAssembler(inputCols=[*filled, *indexed], outputCol=VECTOR)
    prepared = Pipeline(stages=[*fill, *index, assemble]).fit(rows)
    regressors = [
        c.copy().setParams(featuresCol=VECTOR, labelCol="__label", predictionCol=prediction)
        for c in candidates or default_candidates()
    ]
    # a tree needs a bin for each value of a category, and one for those it has not seen
    bins = 1 + max((len(x) for m in prepared.stages for x in getattr(m, "labelsArray", [])), default=0)
    for regressor in regressors:
        if regressor.hasParam("maxBins"):
            regressor.setParams(maxBins=max(bins, regressor.getMaxBins()))
    in_training = hash_uniform("__label", *features, seed=1) < train_ratio
    assembled = prepared.transform(rows.withColumn("__training", in_training)).select(
        "__label", VECTOR, "__training"
    )
    best, whole = 0, None
    if len(regressors) > 1:
        path = scratch_path(df.sparkSession, "vectors")
        assembled.write.options(**PLAIN_FILES).parquet(path)
        # the schema keeps what the assembler wrote about categories
        assembled = df.sparkSession.read.schema(assembled.schema).parquet(path)
        sides = {r["__training"]: r["count"] for r in assembled.groupBy("__training").count().collect()}
        if len(sides) < 2:
            raise ValueError("too few rows to hold some back: give one candidate, or more rows")
        training, rows_stored = assembled.where("__training"), sum(sides.values())
        many = rows_stored >= many_rows
        best, made = search(
            regressors, training, assembled.where("not __training"), prediction=prediction,
            shrink=shrink, parallelism=parallelism, budget_seconds=budget_seconds,
            trees=HistogramTrees(training, sides[True], label="__label", vector=VECTOR) if many else None)
        if trials is not None:
            trials += made
        if many:
            whole = HistogramTrees(assembled, rows_stored, label="__label", vector=VECTOR)
    return PipelineModel(stages=[*prepared.stages, _fitted(regressors[best], assembled, whole)])


def predict(df: DataFrame, model: PipelineModel, *, prediction: str = PREDICTION) -> DataFrame:
    """``df`` with the prediction appended; all its columns pass through, so no
    join back to the inputs is needed."""
    return model.transform(df).select(*df.columns, prediction)


def save_model(model: PipelineModel, root: str, name: str) -> str:
    """Store a model under ``root/name``; an earlier one is there, whole, until the new one is."""
    spark = SparkSession.getActiveSession()
    return publish_folder(spark, f"{root.rstrip('/')}/{name}", lambda path: model.write().overwrite().save(path))


def load_model(root: str, name: str) -> PipelineModel:
    return PipelineModel.load(current_path(SparkSession.getActiveSession(), f"{root.rstrip('/')}/{name}"))


def baseline_prediction(
    df: DataFrame,
    model: PipelineModel,
    *,
    keys: Sequence[str] = ("state", "geo_id"),
    share: str = SHARE,
    count: str = MEASURE,
    output: str = "baseline_avg_income",
) -> DataFrame:
    """Predicted income at the current share."""
    scored = predict(df.select(*keys, share, count), model)
    return scored.select(*keys, share, count, F.col(PREDICTION).alias(output))


def what_if(
    df: DataFrame,
    model: PipelineModel,
    *,
    delta: float = -0.01,
    keys: Sequence[str] = ("state", "geo_id"),
    share: str = SHARE,
    count: str = MEASURE,
    baseline: str = "baseline_avg_income",
) -> DataFrame:
    """Effect of moving the share by ``delta``: people joining the labour force,
    predicted income, and the income gained by the whole population. Population
    is ``count / share``, so a zero share gives NULL."""
    shifted = df.select(
        *keys, count, baseline,
        F.col(share).alias("__share"), (F.col(share) + F.lit(delta)).alias(share),
    )
    population = safe_divide(count, "__share")
    gained = F.col(PREDICTION) - F.col(baseline)
    return predict(shifted, model).select(
        *keys,
        round_int(F.lit(-delta) * population).alias("new_labor_force"),
        F.round(PREDICTION, 2).alias("new_income"),
        round_int(gained * population).alias("net_income_increase"),
    )


def score_scenarios(
    df: DataFrame, model: PipelineModel, *, column: str = GRADUATES, output: str = SHARE, keep: Sequence[str] = ()
) -> DataFrame:
    """Scenario value (whole number) and predicted share, ascending by the value; before them the columns to ``keep``."""
    return (
        predict(df, model)
        .select(*keep, round_int(column).alias(column), F.col(PREDICTION).alias(output))
        .orderBy(F.asc(column))
    )
