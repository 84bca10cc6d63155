"""Trips out of an event log, for data that holds no trip records.

The events of a user, in time order, are taken in disjoint pairs: the first of a
pair is where and when a trip starts, the second where and when it ends.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.operators.bucketed import running_over_buckets
from flowtide.schemas import TRIP


def trips_from_events(events: DataFrame) -> DataFrame:
    """Trip records with the declared 13 columns.

    One user may own a large part of the log, so the numbering and the look-ahead
    go over the user's days and never sort a whole user in one task.
    """
    numbered = running_over_buckets(
        events.select(
            "user_id", "ts", "event_id", "event_type", F.to_date("ts").alias("day")
        ),
        group=["user_id"],
        bucket="day",
        order=["ts", "event_id"],
        sums={"position": F.lit(1)},
        leads={"next_ts": "ts", "next_type": "event_type"},
    )
    starts = numbered.where((F.col("position") % 2 == 1) & F.col("next_ts").isNotNull())
    columns = {
        "ride_id": F.col("event_id").cast("string"),
        "rideable_type": F.when(F.col("user_id") % 2 == 0, "classic_bike").otherwise("electric_bike"),
        "started_at": F.col("ts"),
        "ended_at": F.col("next_ts"),
        "start_station_name": F.col("event_type"),
        "start_station_id": F.col("event_type"),
        "end_station_name": F.col("next_type"),
        "end_station_id": F.col("next_type"),
        "start_lat": 40.0 + F.length("event_type") / F.lit(100.0),
        "start_lng": -73.0 - F.length("event_type") / F.lit(100.0),
        # some trips miss a coordinate, so that the NULL rules have work to do
        "end_lat": F.when(F.col("event_id") % 50 != 0, 40.0 + F.length("next_type") / F.lit(100.0)),
        "end_lng": -73.0 - F.length("next_type") / F.lit(100.0),
        "member_casual": F.when(F.col("event_id") % 2 == 0, "member").otherwise("casual"),
    }
    return starts.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in TRIP])


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")
