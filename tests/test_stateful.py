"""Streams with state against the batch result: many batches, any order, a restart, expiry."""

import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.operators.requests import alert_times
from flowtide.session import shared_path
from flowtide.streaming import stateful

FLOWS = "time timestamp_ntz, station string, rideable_type string, flow int"
PREDICTIONS = "time timestamp_ntz, station string, rideable_type string, prediction double"
START = datetime(2024, 3, 1)


def flows(n=600, seed=2):
    draw = random.Random(seed)
    return [
        (START + timedelta(minutes=draw.randrange(3 * 24 * 60), seconds=draw.randrange(60)), draw.choice("ab"),
         draw.choice(["t", "u"]), draw.choice([-1, 1]))
        for _ in range(n)
    ] + [(None, "a", "t", 1)]


class Source:
    """A folder that a stream reads, a file a batch."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path = spark, schema, shared_path(spark, "source")

    def add(self, rows, files):
        for k in range(files):
            part = self.spark.createDataFrame(rows[k::files], self.schema).coalesce(1)
            part.write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def batch_stock(spark, rows):
    slot = F.window("time", "15 minutes").start
    net = spark.createDataFrame(rows, FLOWS).where("time IS NOT NULL").groupBy(
        slot.alias("time"), "station", "rideable_type"
    ).agg(F.sum("flow").alias("n"))
    day = F.to_date("time")
    along = W.partitionBy("station", "rideable_type", day).orderBy("time").rowsBetween(W.unboundedPreceding, 0)
    found = net.select("time", "station", "rideable_type", (10 + F.sum("n").over(along)).alias("stock"), day.alias("day"))
    return sorted(map(tuple, found.collect()))


def test_stock_over_twenty_batches_and_a_restart(spark):
    rows = flows()
    source, path = Source(spark, FLOWS), shared_path(spark, "changes")
    source.add(rows[:300], 10)
    stateful.start_stock(source.stream(), path, f"{path}-progress").awaitTermination()
    assert sorted(map(tuple, stateful.read_stock(spark, path).collect())) == batch_stock(spark, rows[:300])
    source.add(rows[300:], 10)
    query = stateful.start_stock(source.stream(), path, f"{path}-progress")
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 19
    assert sorted(map(tuple, stateful.read_stock(spark, path).collect())) == batch_stock(spark, rows)
    assert stateful.read_late_flows(spark, path).count() == 0


def wait_for(ready, seconds=90):
    end = time.time() + seconds
    while not ready():
        assert time.time() < end
        time.sleep(0.5)


def test_flows_after_expiry_are_handed_out(spark):
    at = START + timedelta(hours=3)
    source, path = Source(spark, FLOWS), shared_path(spark, "expiring")
    source.add([(at, "a", "t", 1)], 1)
    query = stateful.start_stock(source.stream(), path, f"{path}-progress", expire=timedelta(milliseconds=1))
    try:
        wait_for(lambda: (query.lastProgress or {}).get("batchId", 0) >= 3)
        source.add([(at, "b", "t", 1), (at, "a", "t", -1), (at, "a", "t", -1)], 1)
        wait_for(lambda: stateful.read_late_flows(spark, path).count())
    finally:
        query.stop()
    stock = {r["station"]: r["stock"] for r in stateful.read_stock(spark, path).collect()}
    assert stock == {"a": 11, "b": 11}
    assert [tuple(r) for r in stateful.read_late_flows(spark, path).collect()] == [(at, "a", "t", -2)]


def test_alerts_over_many_batches_and_a_restart(spark):
    draw = random.Random(5)
    rows = [
        (START + timedelta(minutes=15 * t), s, "t", draw.choice([None, float(draw.randrange(-40, 20))]))
        for t in range(2 * 96) for s in "ab"
    ]
    draw.shuffle(rows)
    source, path = Source(spark, PREDICTIONS), shared_path(spark, "alert-log")
    source.add(rows[:200], 4)
    stateful.start_alerts(source.stream(), path, f"{path}-progress").awaitTermination()
    again = [(rows[0][0], rows[0][1], "t", -100.0)]  # the later batch counts
    source.add(rows[200:], 4)
    source.add(again, 1)
    stateful.start_alerts(source.stream(), path, f"{path}-progress").awaitTermination()
    whole = spark.createDataFrame([*rows[1:], *again], PREDICTIONS).withColumn("target_day", F.to_date("time"))
    want = alert_times(whole).select("station", "rideable_type", "target_day", F.explode("prediction"))
    got = stateful.read_alerts(spark, path)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


@pytest.mark.parametrize("known", [{}, {0: 5.0}, {0: -1.0, 1: -1.0, 2: -11.0}, {3: float("nan"), 5: -50.0}])
def test_alert_fold(known):
    processor = stateful.DayAlerts(10, 10, 15, None)
    limit, want = 0.0, []
    for slot, value in known.items():
        if value < limit:
            limit -= 10
            want.append(str(START + timedelta(minutes=15 * (slot + 1))))
    assert processor.alerts(START.date(), known) == want


@pytest.mark.parametrize("start, kind, row", [
    (stateful.start_stock, FLOWS, (START, "a", "t", 1)), (stateful.start_alerts, PREDICTIONS, (START, "a", "t", -5.0)),
])
def test_state_partitions_do_not_follow_the_shuffle(spark, start, kind, row):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    source, path = Source(spark, kind), shared_path(spark, "few-partitions")

    def partitions(**options):
        source.add([row], 1)
        query = start(source.stream(), path, f"{path}-progress", **options)
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "23"
        # the last progress may be of an empty batch; its state has as many partitions
        return query.lastProgress["stateOperators"][0]["numShufflePartitions"]

    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        cores = spark.sparkContext.defaultParallelism
        assert partitions() == cores
        assert partitions(partitions=cores + 3) == cores  # as the checkpoint has it
        path = shared_path(spark, "more-partitions")
        assert partitions(partitions=cores + 3) == cores + 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


class Handle:
    """State in memory that counts the calls which a task sends through its socket."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def state(self, name, schema):
        outer = self

        class State:
            def get(self):
                outer.calls += 1
                return outer.held.get(name)

            def exists(self):
                outer.calls += 1
                return name in outer.held

            def update(self, value):
                outer.calls += 1
                outer.held[name] = value

            def updateValue(self, key, value):
                outer.calls += 1
                outer.held.setdefault(name, {})[key] = value

            def iterator(self):
                outer.calls += 1
                return iter(outer.held.get(name, {}).items())

        return State()

    def getValueState(self, name, schema):
        return self.state(name, schema)

    def getMapState(self, name, *schemas):
        return self.state(name, schemas)


@pytest.mark.parametrize("processor, value", [
    (stateful.DayStock(10, 15, None), "flow"), (stateful.DayAlerts(10, 10, 15, None), "prediction"),
])
def test_calls_to_the_state_do_not_grow_with_the_slots(processor, value):
    calls = []
    for slots in (2, 96):
        handle = Handle()
        processor.init(handle)
        for batch in range(3):
            rows = pd.DataFrame({"slot": range(slots), value: -1.0 - batch})
            list(processor.handleInputRows(("a", "t", START.date()), iter([rows]), None))
        calls.append(handle.calls)
    assert calls[0] == calls[1]
