"""State of a stream that is kept by day, exact however late a row arrives.

Each batch writes the new state of the days that it touches, and of no others. A
state is complete, so a day's newest one is all that is ever read of it; the one
before it stays until the next batch, so that a batch that is repeated after a
failure starts from the same state again and replaces what it wrote. Older states
are deleted: a day's folder holds two at most, however long the stream runs.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.session import delete_path, list_folders


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    keys = [T.StructField("day", T.DateType()), T.StructField("batch", T.LongType())]
    whole = T.StructType([*schema, *keys])
    if not list_folders(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def _newest(stored: DataFrame) -> DataFrame:
    last = stored.groupBy("day").agg(F.max("batch").alias("batch"))
    return stored.join(last, ["day", "batch"], "left_semi")


def read_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest state of every day, with its ``day``."""
    return _newest(_stored(spark, path, schema)).select("day", *schema.names)


def merge_days(
    new: DataFrame, number: int, path: str, combine: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Fold a batch into the states of its days; returns these states, as stored.

    ``new`` has ``day`` and the columns of the state. ``combine`` reduces a table of
    the same columns, the earlier state and the batch together, to the new state.
    """
    spark = new.sparkSession
    schema = T.StructType([f for f in new.schema if f.name != "day"])
    # the days of one batch, each a folder to read and to write
    days = [row["day"] for row in new.select("day").distinct().collect()]
    earlier = _stored(spark, path, schema).where(F.col("day").isin(days) & (F.col("batch") < number))
    before = _newest(earlier).select("day", *schema.names)
    state = combine(before.unionByName(new.select("day", *schema.names)))
    # one file a day: a day's state has at most a day's slots of each series
    state.withColumn("batch", F.lit(number)).repartition("day").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("day", "batch").parquet(path)
    for day in days:
        kept = sorted(int(name.removeprefix("batch=")) for name in list_folders(spark, f"{path}/day={day}"))
        for old in [b for b in kept if b < number][:-1]:
            delete_path(spark, f"{path}/day={day}/batch={old}")
    stored = spark.read.schema(_stored(spark, path, schema).schema).parquet(path)
    return stored.where(F.col("day").isin(days) & (F.col("batch") == number)).select("day", *schema.names)
