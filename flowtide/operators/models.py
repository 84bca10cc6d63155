"""Boosted trees: fit, score, evaluate, search."""

import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.constants import (
    CATEGORICAL_FEATURES,
    EXPERIMENT_DEPTH,
    EXPERIMENT_RATE,
    EXPERIMENT_ROUNDS,
    GBT_DEPTH,
    GBT_RATE,
    GBT_ROUNDS,
    MODEL_INPUTS,
    SEARCH_DEPTHS,
    SEARCH_DRAWS,
    SEARCH_FOLDS,
    SEARCH_PARALLELISM,
    SEARCH_RATES,
    SEARCH_ROUNDS,
    SEED,
    TARGET,
)
from flowtide.operators.split import ordered_folds
from flowtide.session import materialize, scratch, shared_folder


MIN_BINS = 128


def gbt_pipeline(
    rounds: int = GBT_ROUNDS,
    depth: int = GBT_DEPTH,
    rate: float = GBT_RATE,
    seed: int = SEED,
    inputs: Sequence[str] = MODEL_INPUTS,
    max_bins: int = MIN_BINS,
) -> Pipeline:
    """Index the categories, assemble the inputs, boost regression trees.

    :func:`fit` raises ``max_bins`` to the number of categories in its data.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    indexer = StringIndexer(
        inputCols=list(CATEGORICAL_FEATURES), outputCols=indexed, handleInvalid="keep"
    )
    numbers = [c for c in inputs if c not in CATEGORICAL_FEATURES]
    assembler = VectorAssembler(
        inputCols=[*indexed, *numbers], outputCol="inputs", handleInvalid="keep"
    )
    booster = GBTRegressor(
        featuresCol="inputs",
        labelCol=TARGET,
        predictionCol="prediction",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        seed=seed,
        maxBins=max_bins,
        maxMemoryInMB=1024,
        checkpointInterval=10,
    )
    return Pipeline(stages=[indexer, assembler, booster])


def fit_gbt(features: DataFrame, **options) -> PipelineModel:
    """Fit on all rows whose inputs are known. The defaults are the registered model's."""
    return fit(gbt_pipeline(**options), features)


# The earlier, deeper setting: fit_gbt(features, **EXPERIMENT)
EXPERIMENT = {"rounds": EXPERIMENT_ROUNDS, "depth": EXPERIMENT_DEPTH, "rate": EXPERIMENT_RATE}


def fit(pipeline: Pipeline, features: DataFrame) -> PipelineModel:
    """Fit on the rows that have all inputs and a target."""
    pipeline, rows = _ready(pipeline, features)
    return pipeline.fit(rows)


def _ready(pipeline: Pipeline, features: DataFrame) -> tuple[Pipeline, DataFrame]:
    """The rows that can be learned from, and the pipeline with a bin for each category."""
    context = features.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(features.sparkSession))
    indexer, assembler, booster = pipeline.getStages()
    kinds = indexer.getInputCols()
    numbers = [c for c in assembler.getInputCols() if c not in indexer.getOutputCols()]
    rows = features.na.drop(subset=[*kinds, *numbers, booster.getLabelCol()])
    counts = rows.agg(*[F.count_distinct(c).alias(c) for c in kinds]).first()
    # a tree needs a bin for each category, and one for those it has not seen
    bins = max(booster.getMaxBins(), max(counts) + 2)
    return Pipeline(stages=[indexer, assembler, booster.copy({booster.maxBins: bins})]), rows


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The features with a ``prediction`` column, NULL where there can be none.

    That is where an input is NULL, or a category was not seen in training. No row
    is left out.
    """
    indexer, assembler = model.stages[0], model.stages[1]
    known = F.lit(True)
    for index, labels in zip(indexer.getOutputCols(), indexer.labelsArray, strict=True):
        known &= F.col(index) < len(labels)
    for number in assembler.getInputCols():
        if number not in indexer.getOutputCols():
            known &= F.col(number).isNotNull()
    scored = model.transform(features)
    return scored.select(*features.columns, F.when(known, F.col("prediction")).alias("prediction"))


def evaluate(scored: DataFrame, target: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """One row of held-out metrics, and how many rows had no prediction or target."""
    error = F.col(target) - F.col(prediction)
    squared = F.avg(F.pow(error, 2))
    return scored.agg(
        F.count(error).alias("n"),
        F.count_if(error.isNull()).alias("n_unscored"),
        F.sqrt(squared).alias("rmse"),
        squared.alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.max(F.abs(error)).alias("max_error"),
        (F.lit(1.0) - F.try_divide(squared, F.var_pop(target))).alias("r2"),
    )


def feature_importance(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Share of the model's gain per input, largest first."""
    assembler, booster = model.stages[-2], model.stages[-1]
    rows = [
        (name.removesuffix("_index"), float(value))
        for name, value in zip(assembler.getInputCols(), booster.featureImportances.toArray(), strict=True)
    ]
    table = features.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def random_search(
    features: DataFrame,
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    parallelism: int = SEARCH_PARALLELISM,
    rounds: tuple[int, int] = SEARCH_ROUNDS,
    depths: tuple[int, int] = SEARCH_DEPTHS,
    rates: tuple[float, float] = SEARCH_RATES,
    seed: int = SEED,
    inputs: Sequence[str] = MODEL_INPUTS,
) -> CrossValidatorModel:
    """Best of ``draws`` random settings by mean squared error over ``folds`` folds.

    The folds are contiguous blocks of rows in time order. Rounds and depths are
    drawn below their upper bound, rates up to it. ``features`` has its ``time``.
    """
    with scratch(features.sparkSession):
        return _search(features, draws, folds, parallelism, rounds, depths, rates, seed, inputs)


def _search(features, draws, folds, parallelism, rounds, depths, rates, seed, inputs) -> CrossValidatorModel:
    stored = materialize(features, "search")
    blocks = materialize(ordered_folds(stored, folds), "folds")
    pipeline, blocks = _ready(gbt_pipeline(seed=seed, inputs=inputs), blocks)
    booster = pipeline.getStages()[-1]
    draw = random.Random(seed)
    settings = [
        {
            booster.maxIter: draw.randrange(*rounds),
            booster.maxDepth: draw.randrange(*depths),
            booster.stepSize: min(draw.uniform(*rates), 1.0),
        }
        for _ in range(draws)
    ]
    evaluator = RegressionEvaluator(
        labelCol=TARGET, predictionCol="prediction", metricName="mse"
    )
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=settings,
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    return search.fit(blocks)
