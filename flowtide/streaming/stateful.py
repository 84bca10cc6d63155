"""Daily stock and alerts of a stream by Spark's own state: one state a series and day.

The state of a series and day has at most a day's slots. A row that arrives late changes
its slot and all that follows from it, so results equal those of a batch whatever the
order. With ``expire``, a timer gives up a day's state when nothing came for that long;
flows that come even later are not lost but handed out as late flows. Such a query runs
until it is stopped; without ``expire`` it ends when it has read what there is.

State is kept in RocksDB and goes into the checkpoint of the query with the position in
the source, so a query that is started again goes on where it ended. Results are a log
of changes, appended once; the readers take the newest one.

A day's slots are one value of the state: a batch reads it and writes it once a series and
day, since every call to the state goes through a socket, whatever it carries.

Every batch loads and commits every partition of the state, however few rows it has. So
their number does not follow ``spark.sql.shuffle.partitions``: it is one a core unless
``partitions`` says otherwise, and the checkpoint keeps it.

A batch's rows of one series and day are one task's work; so are its flows of a station
that has a third of all.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, time, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from flowtide.constants import ALERT_STEP, INITIAL_STOCK, SERIES, SLOT_MINUTES

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS = "spark.sql.shuffle.partitions"
KEY = (*SERIES, "day")
CHANGES = "station string, rideable_type string, day date, slot int, stock bigint, version bigint, late_flow bigint"
ALERTS = "station string, rideable_type string, day date, alerts array<string>, version bigint"


@contextmanager
def _rocks(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, in so many partitions."""
    wanted = {_PROVIDER: _ROCKS, _PARTITIONS: str(partitions)}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class _OfDay(StatefulProcessor):
    """What both processors share: a version, and a timer that ends a day."""

    def __init__(self, slot_minutes: int, expire: timedelta | None):
        self.slot_minutes = slot_minutes
        self.expire_ms = None if expire is None else max(1, int(expire.total_seconds() * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.about = handle.getValueState(
            "about", "version bigint, closed boolean, slots array<int>, values array<double>"
        )

    def known(self) -> tuple[int, bool, dict[int, float]]:
        """The version, whether the day is closed, and the values by slot."""
        version, closed, slots, values = self.about.get() or (0, False, [], [])
        return version, closed, dict(zip(slots, values, strict=True))

    def keep(self, version: int, closed: bool, values: dict[int, float]) -> None:
        self.about.update((version, closed, list(values), list(values.values())))

    def wait(self, timers) -> None:
        """The day ends if nothing comes from now on for ``expire``."""
        if self.expire_ms is None:
            return
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.expire_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.keep(self.known()[0], True, {})
        return iter(())

    def close(self) -> None:
        pass


class DayStock(_OfDay):
    """Adds up flows by slot; hands out the stock from the first slot that changed on."""

    def __init__(self, initial_stock: int, slot_minutes: int, expire: timedelta | None):
        super().__init__(slot_minutes, expire)
        self.initial_stock = initial_stock

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(part.groupby("slot")["flow"].sum() for part in rows).groupby(level=0).sum()
        before, closed, total = self.known()
        version = before + 1
        if closed:
            made = pd.DataFrame({"slot": new.index, "stock": None, "late_flow": new.to_numpy()})
        else:
            for slot, flow in new.items():
                total[int(slot)] = total.get(slot, 0.0) + float(flow)
            self.wait(timerValues)
            running = self.initial_stock + pd.Series(total, dtype="float64").sort_index().cumsum()
            changed = running[running.index >= new.index.min()].astype("int64")
            made = pd.DataFrame({"slot": changed.index, "stock": changed.to_numpy(), "late_flow": None})
        self.keep(version, closed, total)
        made = made.astype({"slot": "int32", "stock": "Int64", "late_flow": "Int64"})
        yield made.assign(**dict(zip(KEY, key, strict=True)), version=version)[
            [*KEY, "slot", "stock", "version", "late_flow"]
        ]


class DayAlerts(_OfDay):
    """Keeps predictions by slot; hands out the day's alerts whenever they change."""

    def __init__(self, initial_stock: int, step: int, slot_minutes: int, expire: timedelta | None):
        super().__init__(slot_minutes, expire)
        self.first_limit, self.step = float(initial_stock - step), float(step)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "alerts array<string>")

    def alerts(self, day, known: dict[int, float]) -> list[str]:
        """Times of the slots after those whose prediction is below the limit, which each alert lowers."""
        limit, found = self.first_limit, []
        midnight = datetime.combine(day, time())
        for slot in sorted(known):
            if known[slot] < limit:
                limit -= self.step
                found.append(str(midnight + timedelta(minutes=self.slot_minutes * (slot + 1))))
        return found

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # of a slot sent twice the later batch counts, and in a batch the greatest
        new = pd.concat(part.groupby("slot", dropna=False)["prediction"].max() for part in rows).groupby(level=0).max()
        before, closed, known = self.known()
        version = before + 1
        if not closed:
            known |= {int(slot): float(value) for slot, value in new.items()}  # no prediction is NaN, below no limit
        self.keep(version, closed, known)
        if closed:
            return
        self.wait(timerValues)
        found = self.alerts(key[-1], known)
        if not self.last.exists() or list(self.last.get()[0]) != found:
            self.last.update((found,))
            row = dict(zip(KEY, key, strict=True)) | {"alerts": found, "version": version}
            yield pd.DataFrame([row])


def _started(
    rows: DataFrame, processor: _OfDay, schema: str, path: str, progress: str, partitions: int | None
) -> StreamingQuery:
    partitions = partitions or rows.sparkSession.sparkContext.defaultParallelism
    mode = "none" if processor.expire_ms is None else "processingTime"
    changes = rows.groupBy(*KEY).transformWithStateInPandas(processor, schema, "Append", mode)
    # a timer asks for one batch after the other, so such a query runs until it is stopped
    trigger = {"availableNow": True} if processor.expire_ms is None else {"processingTime": "1 second"}
    with _rocks(rows.sparkSession, partitions):
        return (
            changes.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", progress)
            .trigger(**trigger)
            .start()
        )


def _dated(rows: DataFrame, slot_minutes: int, value: str) -> DataFrame:
    minute = F.hour("time") * 60 + F.minute("time")
    return rows.where(F.col("time").isNotNull()).select(
        *SERIES, F.to_date("time").alias("day"), F.floor(minute / slot_minutes).cast("int").alias("slot"), value
    )


def start_stock(
    flows: DataFrame, path: str, progress: str, initial_stock: int = INITIAL_STOCK,
    slot_minutes: int = SLOT_MINUTES, expire: timedelta | None = None, partitions: int | None = None,
) -> StreamingQuery:
    """Start a query that logs the stock after every busy slot whenever it changes.

    ``flows`` hold time, station, type and flow. Flows without a time belong to no slot.
    """
    rows = _dated(flows.withColumn("flow", F.col("flow").cast("bigint")), slot_minutes, "flow")
    return _started(rows, DayStock(initial_stock, slot_minutes, expire), CHANGES, path, progress, partitions)


def _slot_time(slot_minutes: int):
    at = F.make_dt_interval(mins=F.col("slot") * slot_minutes)
    return (F.col("day").cast("timestamp_ntz") + at).alias("time")


def read_stock(spark: SparkSession, path: str, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """``time, station, rideable_type, stock, day``: the newest stock of every busy slot."""
    log = spark.read.schema(CHANGES).parquet(path).where(F.col("stock").isNotNull())
    newest = log.groupBy(*KEY, "slot").agg(F.max_by("stock", "version").alias("stock"))
    return newest.select(_slot_time(slot_minutes), *SERIES, "stock", "day")


def read_late_flows(spark: SparkSession, path: str, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """``time, station, rideable_type, net_flow``: flows that came after their day's state had expired."""
    log = spark.read.schema(CHANGES).parquet(path).where(F.col("late_flow").isNotNull())
    sums = log.groupBy(*KEY, "slot").agg(F.sum("late_flow").alias("net_flow"))
    return sums.select(_slot_time(slot_minutes), *SERIES, "net_flow")


def start_alerts(
    predictions: DataFrame, path: str, progress: str, initial_stock: int = INITIAL_STOCK,
    step: int = ALERT_STEP, slot_minutes: int = SLOT_MINUTES, expire: timedelta | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a query that logs a day's alerts whenever they change.

    ``predictions`` hold time, station, type and the prediction for the next slot, in any
    order. Predictions for a day whose state has expired change nothing.
    """
    rows = _dated(predictions.withColumn("prediction", F.col("prediction").cast("double")), slot_minutes, "prediction")
    return _started(rows, DayAlerts(initial_stock, step, slot_minutes, expire), ALERTS, path, progress, partitions)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """One row per alert of the newest alerts of every series and day."""
    log = spark.read.schema(ALERTS).parquet(path)
    newest = log.groupBy(*KEY).agg(F.max_by("alerts", "version").alias("alerts"))
    return newest.select(*SERIES, "day", F.explode("alerts").alias("alert"))
