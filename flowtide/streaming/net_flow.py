"""Net flow per slot of a stream of flows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtide.constants import SERIES, SLOT_MINUTES
from flowtide.operators.series import net_flow
from flowtide.streaming.day_state import merge_days, read_days

NET_FLOW = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("station", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("net_flow", T.LongType()),
    ]
)


def add_flows(batch: DataFrame, number: int, path: str, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """Add a batch of flows to the net flow of its days; returns that of these days.

    A flow without a time belongs to no slot.
    """
    net = net_flow(batch.where(F.col("time").isNotNull()), slot_minutes)
    dated = net.select(F.to_date("time").alias("day"), *NET_FLOW.names)
    return merge_days(
        dated,
        number,
        path,
        lambda rows: rows.groupBy("day", "time", *SERIES).agg(F.sum("net_flow").alias("net_flow")),
    )


def start_net_flow(
    flows: DataFrame, path: str, progress: str, slot_minutes: int = SLOT_MINUTES
) -> StreamingQuery:
    """Start a query that keeps the net flow of every slot.

    There is no watermark: a trip brings its end along, hours after flows that are
    still to come, so no flow can be called too late. A batch costs the days it touches.
    """
    return (
        flows.writeStream.foreachBatch(lambda batch, number: add_flows(batch, number, path, slot_minutes))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def read_net_flow(spark: SparkSession, path: str) -> DataFrame:
    return read_days(spark, path, NET_FLOW).select(*NET_FLOW.names)
