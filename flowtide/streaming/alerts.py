"""Stock-out alerts from a stream of predictions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtide.constants import ALERT_STEP, INITIAL_STOCK, SERIES, SLOT_MINUTES
from flowtide.operators.requests import alert_times
from flowtide.streaming.day_state import merge_days

DAY_ALERTS = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("alerts", T.ArrayType(T.StringType())),
        T.StructField("day", T.DateType()),
    ]
)


def start_alerts(
    predictions: DataFrame,
    path: str,
    progress: str,
    initial_stock: int = INITIAL_STOCK,
    step: int = ALERT_STEP,
    slot_minutes: int = SLOT_MINUTES,
) -> StreamingQuery:
    """Start a query that keeps the alerts of every day.

    ``predictions`` hold time, station, type and the prediction for the next slot, in
    any order. A day's predictions are kept, and its alerts worked out again from all
    of them when a batch touches the day; of a slot sent twice the later batch counts.
    """

    def merge(batch: DataFrame, number: int) -> None:
        sent = batch.where(F.col("time").isNotNull()).select(
            F.to_date("time").alias("day"),
            "time",
            *SERIES,
            F.struct(F.lit(number).alias("sent"), F.col("prediction").cast("double").alias("value")).alias("latest"),
        )
        state = merge_days(
            sent,
            number,
            f"{path}/predictions",
            lambda rows: rows.groupBy("day", "time", *SERIES).agg(F.max("latest").alias("latest")),
        )
        scored = state.select(F.col("day").alias("target_day"), "time", *SERIES, F.col("latest.value").alias("prediction"))
        found = alert_times(scored, initial_stock, step, slot_minutes)
        rows = found.select(*SERIES, F.col("prediction").alias("alerts"), F.col("target_day").alias("day"))
        rows.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "day"
        ).parquet(f"{path}/alerts")

    return (
        predictions.writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """One row per alert."""
    days = spark.read.schema(DAY_ALERTS).parquet(f"{path}/alerts")
    return days.select(*SERIES, "day", F.explode("alerts").alias("alert"))
