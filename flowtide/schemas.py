"""Declared schemas. Nothing in the library infers a schema from data."""

from pyspark.sql import types as T

TRIP = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("start_station_name", T.StringType()),
        T.StructField("start_station_id", T.StringType()),
        T.StructField("end_station_name", T.StringType()),
        T.StructField("end_station_id", T.StringType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lng", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lng", T.DoubleType()),
        T.StructField("member_casual", T.StringType()),
    ]
)

# Trip files as text: every column is a string until it has been cast.
TRIP_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in TRIP])

PREPROCESSED = (
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "end_station_name",
)

COLUMN_DRIFT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("drift_score", T.DoubleType()),
        T.StructField("is_drift", T.BooleanType()),
    ]
)

DATASET_SUMMARY = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("number_of_drifted_columns", T.IntegerType()),
        T.StructField("share_of_drifted_columns", T.DoubleType()),
        T.StructField("dataset_drift", T.BooleanType()),
    ]
)

MODEL_PERFORMANCE = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("abs_error_max", T.DoubleType()),
    ]
)

METRIC_TABLES = {
    "column_drift": (COLUMN_DRIFT, ("timestamp", "column_name")),
    "dataset_summary": (DATASET_SUMMARY, ("timestamp",)),
    "model_performance": (MODEL_PERFORMANCE, ("timestamp",)),
}

REQUEST = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("target_date", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("model_path", T.StringType()),
    ]
)

CHAMPION = T.StructType(
    [
        T.StructField("alias", T.StringType()),
        T.StructField("promotion", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("model_path", T.StringType()),
    ]
)
