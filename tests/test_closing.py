"""Closing of slots: final once, late flows counted, nothing lost, over batches and a restart."""

from datetime import datetime, timedelta

from test_stateful import FLOWS, Source, flows

from flowtide.operators.series import net_flow
from flowtide.session import shared_path
from flowtide.streaming import closing

START = datetime(2024, 3, 1)


def plain(rows):
    found = {}
    for time, station, kind, flow in rows:
        if time is not None:
            slot = START + timedelta(minutes=(time - START) // timedelta(minutes=15) * 15)
            found[slot, station, kind] = found.get((slot, station, kind), 0) + flow
    return sorted((*k, v) for k, v in found.items())


def test_parts_add_up_after_a_restart(spark):
    rows = sorted(flows(400), key=lambda r: r[0] or START)
    for i in range(0, len(rows) - 40, 25):  # some come long after their neighbours
        rows.append(rows.pop(i))
    size = len(rows) // 10 + 1
    batches = [rows[k : k + size] for k in range(0, len(rows), size)]
    source, path = Source(spark, FLOWS), shared_path(spark, "closing")
    for part in (batches[:5], batches[5:]):
        for batch in part:
            source.add(batch, 1)
        closing.start_closing(source.stream(), path, f"{path}-progress").awaitTermination()
    whole = sorted(map(tuple, closing.read_all(spark, path).collect()))
    assert whole == plain(rows)
    assert whole == sorted(map(tuple, net_flow(spark.createDataFrame(rows, FLOWS).where("time IS NOT NULL")).collect()))
    assert closing.read_late(spark, path).count() and closing.read_closed(spark, path).count()
    # a slot is closed once
    closed = closing.read_closed(spark, path)
    assert closed.count() == closed.select("time", "station", "rideable_type").distinct().count()
    # the delay bounds the open slots
    newest = max(r[0] for r in rows if r[0])
    assert min(r["time"] for r in closing.read_open(spark, path).collect()) > newest - closing.DELAY - timedelta(minutes=30)


def test_mark_and_repeated_batches(spark):
    path, hour = shared_path(spark, "closing"), timedelta(hours=1)
    batch = lambda *rows: spark.createDataFrame(list(rows), FLOWS)
    at = START + timedelta(minutes=20)
    close = lambda df, n: closing.close_slots(df, n, path, delay=hour)
    close(batch((at, "a", "t", 1), (None, "a", "t", 5)), 0)
    assert closing.read_closed(spark, path).count() == 0
    # exactly an hour after the slot's end it is final, and this batch's own flow still counts
    close(batch((START + timedelta(minutes=90), "a", "t", 1), (at, "a", "t", 1)), 1)
    assert [tuple(r) for r in closing.read_closed(spark, path).collect()] == [(START + timedelta(minutes=15), "a", "t", 2)]
    for _ in range(2):  # a batch that is repeated counts once
        close(batch((at, "a", "t", -1), (at, "a", "t", -1)), 2)
    assert [tuple(r) for r in closing.read_late(spark, path).collect()] == [(START + timedelta(minutes=15), "a", "t", -2, 2)]
    close(batch(), 3)
    assert sorted(map(tuple, closing.read_all(spark, path).collect())) == [
        (START + timedelta(minutes=15), "a", "t", 0), (START + timedelta(minutes=90), "a", "t", 1),
    ]
