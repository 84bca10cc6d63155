"""Staging, null handling and the duration outlier cut."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.constants import MAX_Z
from flowtide.functions.calendar import clock_hours, duration_minutes, parse_timestamp
from flowtide.functions.statistics import z_score
from flowtide.schemas import PREPROCESSED, TRIP


def stage_trips(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The declared columns with the declared types, in the declared order."""
    return raw.select(
        *[
            parse_timestamp(F.col(f.name), strict).alias(f.name)
            if f.dataType.typeName() == "timestamp_ntz"
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in TRIP
        ]
    )


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a NULL, in all columns or in ``subset``."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def preprocess(trips: DataFrame) -> DataFrame:
    """Five columns of the trips that have no NULL in any of the thirteen."""
    return drop_nulls(trips).select(*PREPROCESSED)


def with_clock_and_duration(trips: DataFrame) -> DataFrame:
    return trips.select(
        "*",
        clock_hours("started_at").alias("start_time"),
        clock_hours("ended_at").alias("end_time"),
        duration_minutes("started_at", "ended_at").alias("duration"),
    )


def duration_stats(trips: DataFrame) -> DataFrame:
    """One row: number of trips, mean and sample deviation of the minutes."""
    duration = duration_minutes("started_at", "ended_at")
    return trips.agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.avg(duration).alias("mean_duration"),
        F.stddev_samp(duration).alias("std_duration"),
    )


def _scored(trips: DataFrame):
    stats = duration_stats(trips).select(F.struct("mean_duration", "std_duration").alias("s"))
    # a scalar subquery: two numbers reach the tasks, no join is planned
    s = stats.scalar()
    return F.abs(z_score(F.col("duration"), s["mean_duration"], s["std_duration"]))


def remove_outlier(trips: DataFrame, max_z: float = MAX_Z) -> DataFrame:
    """Trips whose duration lies within ``max_z`` sample deviations of the mean.

    A single trip, or trips of equal duration, have no z-score and are dropped.
    """
    return with_clock_and_duration(trips).where(_scored(trips) <= max_z)


def duration_outliers(trips: DataFrame, max_z: float = MAX_Z) -> DataFrame:
    """The trips that :func:`remove_outlier` drops for a z-score above ``max_z``."""
    return with_clock_and_duration(trips).where(_scored(trips) > max_z)
