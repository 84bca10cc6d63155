"""Backfill of the monitoring tables: all days of a month in one job each."""

from datetime import date
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.operators.drift import column_drift, daily_performance, drift_summary, with_day
from flowtide.operators.models import score
from flowtide.operators.upsert import upsert_keep_first, upsert_partial
from flowtide.session import materialize, scratch
from flowtide.sources.tables import ensure_metric_tables

# Versions of a metric table that stay for readers which have begun.
KEPT_VERSIONS = 10


def days_of_month(features: DataFrame, month: date) -> DataFrame:
    """The feature rows of one calendar month, with their ``day``."""
    first = F.lit(month.isoformat()).cast("date")
    dated = with_day(features)
    return dated.where(F.trunc("day", "month") == F.trunc(first, "month"))


def backfill_drift(
    spark: SparkSession, root: str, reference: DataFrame, current: DataFrame, month: date
) -> None:
    """Column drift and its summary for every day of ``month`` that has rows.

    Column scores of days already reported stay; of a reported summary only the
    number of drifted columns is refreshed.
    """
    tables = ensure_metric_tables(spark, root)
    columns, summaries = tables["column_drift"], tables["dataset_summary"]
    with scratch(spark):
        drift = materialize(column_drift(reference, days_of_month(current, month)), "drift")
        summary = drift_summary(drift)
        columns.merge(drift, partial(upsert_keep_first, keys=columns.keys))
        refreshed = ["number_of_drifted_columns"]
        summaries.merge(summary, partial(upsert_partial, keys=summaries.keys, update_columns=refreshed))
    for table in (columns, summaries):
        table.expire(KEPT_VERSIONS)


def backfill_performance(
    spark: SparkSession, root: str, model: PipelineModel, current: DataFrame, month: date
) -> None:
    """Model error for every day of ``month``; days already reported stay."""
    table = ensure_metric_tables(spark, root)["model_performance"]
    scored = score(model, days_of_month(current, month))
    with scratch(spark):
        table.merge(daily_performance(scored), partial(upsert_keep_first, keys=table.keys))
    table.expire(KEPT_VERSIONS)
