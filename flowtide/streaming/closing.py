"""Net flow of a stream, slot by slot, with a word on when a slot is final.

The mark is the latest time seen so far, less the delay that flows are given. A slot is
closed by the batch whose mark passes its end: it is appended to the closed slots once
and never changes. A flow of a slot that was closed before its batch is counted in a
table of late flows, and lost nowhere: closed, open and late flows add up to all flows.

Spark's own watermark would close slots too, but drops late rows without a trace. So
each batch folds its flows into the open slots, which the delay bounds, and writes its
part of every table under its own number; a batch that is repeated replaces it.
"""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtide.constants import SERIES, SLOT_MINUTES
from flowtide.operators.series import net_flow
from flowtide.session import delete_path, list_folders
from flowtide.streaming.net_flow import NET_FLOW

LATE = T.StructType([*NET_FLOW, T.StructField("n_flows", T.LongType())])
_MARK = T.StructType([T.StructField("seen", T.TimestampNTZType())])
DELAY = timedelta(hours=2)


def _part(spark: SparkSession, path: str, table: str, number: int, schema: T.StructType) -> DataFrame:
    """A table's part by the newest batch before ``number``, empty if there is none."""
    earlier = [b for b in _batches(spark, f"{path}/{table}") if b < number]
    if not earlier:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{table}/batch={max(earlier)}")


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removeprefix("batch=")) for name in list_folders(spark, path))


def close_slots(
    batch: DataFrame, number: int, path: str, delay: timedelta = DELAY, slot_minutes: int = SLOT_MINUTES
) -> None:
    """Fold one batch of flows into the tables under ``path``. Flows without a time belong to no slot."""
    spark = batch.sparkSession
    write = lambda df, table: df.write.mode("overwrite").parquet(f"{path}/{table}/batch={number}")
    timed = batch.where(F.col("time").isNotNull()).persist()
    try:
        before = _part(spark, path, "mark", number, _MARK).agg(F.max("seen")).first()[0]
        newest = timed.agg(F.max("time")).first()[0]
        seen = max((t for t in (before, newest) if t is not None), default=None)
        slot = timedelta(minutes=slot_minutes)
        # the starts of slots that are final: before this batch, and after it
        final = [None if t is None else t - delay - slot for t in (before, seen)]
        is_late = F.lit(False) if final[0] is None else F.col("time") <= F.lit(final[0])
        slot_start = F.window("time", f"{slot_minutes} minutes").start
        flows = timed.withColumn("time", slot_start)
        late = flows.where(is_late).groupBy("time", *SERIES).agg(
            F.sum("flow").cast("bigint").alias("net_flow"), F.count("*").alias("n_flows")
        )
        write(late, "late")
        new = net_flow(flows.where(~is_late), slot_minutes).select(*NET_FLOW.names)
        known = _part(spark, path, "open", number, NET_FLOW).unionByName(new)
        slots = known.groupBy("time", *SERIES).agg(F.sum("net_flow").alias("net_flow"))
        is_final = F.lit(False) if final[1] is None else F.col("time") <= F.lit(final[1])
        write(slots.where(is_final), "closed")
        write(slots.where(~is_final), "open")
        write(spark.createDataFrame([(seen,)], _MARK), "mark")
    finally:
        timed.unpersist()
    # a repeated batch needs the one before it, and nothing older
    for table in ("open", "mark"):
        for old in [b for b in _batches(spark, f"{path}/{table}") if b < number][:-1]:
            delete_path(spark, f"{path}/{table}/batch={old}")


def start_closing(
    flows: DataFrame, path: str, progress: str, delay: timedelta = DELAY, slot_minutes: int = SLOT_MINUTES
) -> StreamingQuery:
    """Start a query that closes slots. The delay also bounds what a batch has to read again."""
    return (
        flows.writeStream.foreachBatch(lambda batch, number: close_slots(batch, number, path, delay, slot_minutes))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def read_closed(spark: SparkSession, path: str) -> DataFrame:
    """Slots that are final, each once."""
    return spark.read.schema(NET_FLOW).parquet(f"{path}/closed").select(*NET_FLOW.names)


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Slots that flows on time may still change."""
    last = max(_batches(spark, f"{path}/open"))
    return spark.read.schema(NET_FLOW).parquet(f"{path}/open/batch={last}")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """By slot: the net flow that came too late, and how many flows it was."""
    rows = spark.read.schema(LATE).parquet(f"{path}/late")
    return rows.groupBy("time", *SERIES).agg(F.sum("net_flow").alias("net_flow"), F.sum("n_flows").alias("n_flows"))


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """Closed, open and late flows together: the net flow of all that came."""
    parts = read_closed(spark, path).unionByName(read_open(spark, path))
    late = read_late(spark, path).select(*NET_FLOW.names)
    return parts.unionByName(late).groupBy("time", *SERIES).agg(F.sum("net_flow").alias("net_flow"))
