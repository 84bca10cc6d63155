"""Running stock of the days a stream touches, kept current as flows arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtide.constants import INITIAL_STOCK, SERIES, SLOT_MINUTES
from flowtide.streaming.net_flow import add_flows

DAILY_STOCK = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("station", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("stock", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)


def start_daily_stock(
    flows: DataFrame,
    path: str,
    progress: str,
    initial_stock: int = INITIAL_STOCK,
    slot_minutes: int = SLOT_MINUTES,
) -> StreamingQuery:
    """Start a query that keeps the stock after every busy slot, one folder per day.

    Each batch adds its flows to the net flow of the days it touches and rewrites
    their stock, late flows included. Other days are neither read nor written.
    """

    def merge(batch: DataFrame, number: int) -> None:
        total = add_flows(batch, number, f"{path}/net_flow", slot_minutes)
        along = W.partitionBy(*SERIES, "day").orderBy("time").rowsBetween(W.unboundedPreceding, 0)
        stock = (F.lit(initial_stock) + F.sum("net_flow").over(along)).cast("bigint")
        running = total.select("time", *SERIES, stock.alias("stock"), "day").repartition("day")
        running.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "day"
        ).parquet(f"{path}/stock")

    return (
        flows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def read_daily_stock(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_STOCK).parquet(f"{path}/stock")
