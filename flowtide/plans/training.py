"""Train, log the run, keep the best model as champion."""

import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.constants import TRAIN_FRACTION
from flowtide.operators.models import evaluate, fit_gbt, score
from flowtide.operators.split import ordered_split
from flowtide.schemas import CHAMPION, RUN_LOG
from flowtide.session import materialize, scratch

METRIC = "test_rmse"


def log_run(
    spark: SparkSession,
    root: str,
    params: dict[str, str],
    metrics: dict[str, float],
    tags: dict[str, str] | None = None,
    model: PipelineModel | None = None,
) -> str:
    """Append a run to the run log under ``root`` and save its model. Returns its id."""
    run_id = uuid.uuid4().hex
    path = None
    if model is not None:
        path = f"{root}/models/{run_id}"
        model.write().overwrite().save(path)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = (run_id, now, {k: str(v) for k, v in params.items()}, metrics, tags or {}, path)
    spark.createDataFrame([row], RUN_LOG).write.mode("append").parquet(f"{root}/runs")
    return run_id


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(f"{root}/runs")


def best_run(runs: DataFrame, metric: str = METRIC) -> DataFrame:
    """The run with the least ``metric``; runs without it come last."""
    value = F.col("metrics")[metric]
    return runs.orderBy(value.asc_nulls_last(), "run_id").limit(1)


def promote_if_best(spark: SparkSession, root: str, run_id: str, metric: str = METRIC) -> bool:
    """Make the run champion when no logged run is better. The earlier one stays otherwise."""
    best = best_run(read_runs(spark, root), metric).first()
    if best is None or best.run_id != run_id:
        return False
    try:
        champions = spark.read.schema(CHAMPION).parquet(f"{root}/champion")
        last = champions.agg(F.max("promotion")).first()[0] or 0
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        last = 0
    row = ("champion", last + 1, run_id, best.model_path)
    spark.createDataFrame([row], CHAMPION).write.mode("append").parquet(f"{root}/champion")
    return True


def load_champion(spark: SparkSession, root: str) -> PipelineModel:
    champions = spark.read.schema(CHAMPION).parquet(f"{root}/champion")
    current = champions.orderBy(F.desc("promotion")).first()
    return PipelineModel.load(current.model_path)


def score_with_champion(spark: SparkSession, root: str, features: DataFrame) -> DataFrame:
    """The features with the champion's predictions."""
    return score(load_champion(spark, root), features)


def parameters(model: PipelineModel) -> dict[str, str]:
    """The settings that a model was fitted with, defaults included."""
    booster = model.stages[-1]
    named = {"rounds": "maxIter", "depth": "maxDepth", "rate": "stepSize", "seed": "seed", "max_bins": "maxBins"}
    return {name: str(booster.getOrDefault(param)) for name, param in named.items()}


def fit_and_evaluate(
    features: DataFrame, train_fraction: float | None = TRAIN_FRACTION, **options
) -> tuple[PipelineModel, DataFrame | None]:
    """Fit on the first part by time and score the rest; or fit on all rows.

    ``features`` has its ``time``. Returns the model and the scored held-out rows.
    """
    if train_fraction is None:
        return fit_gbt(features, **options), None
    stored = materialize(features, "features")
    split = materialize(ordered_split(stored, train_fraction), "split", ("is_train",))
    model = fit_gbt(split.where("is_train"), **options)
    return model, score(model, split.where(~F.col("is_train")).drop("is_train"))


def train_and_promote(features: DataFrame, root: str, **options) -> tuple[str, float, bool]:
    """One training run: fit, evaluate, log, promote when best."""
    spark = features.sparkSession
    with scratch(spark):
        model, scored = fit_and_evaluate(features, **options)
        rmse = evaluate(scored).first().rmse
    params = parameters(model) | {k: str(v) for k, v in options.items()}
    tags = {"model_type": "gbt"}
    run_id = log_run(spark, root, params, {METRIC: rmse}, tags, model)
    return run_id, rmse, promote_if_best(spark, root, run_id)
