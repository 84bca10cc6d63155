"""Cleaning to features on small trips with known results."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import trip, ts
from pyspark.sql import functions as F

from flowtide.operators import clean, features, reshape, series, stations
from flowtide.plans import elt
from flowtide.schemas import TRIP


def test_preprocess_keeps_five_columns(three_trips):
    assert set(clean.preprocess(three_trips).columns) == {
        "rideable_type", "started_at", "ended_at", "start_station_name", "end_station_name",
    }


def test_a_null_in_any_column_drops_the_trip(spark):
    rows = [
        trip("A", "St1", "St2", "2024-01-01 08:00:00", "2024-01-01 08:10:00", end_lat=None),
        trip("B", "St1", "St2", "2024-01-01 08:00:00", "2024-01-01 08:10:00"),
    ]
    trips = spark.createDataFrame(rows, TRIP)
    assert clean.preprocess(trips).count() == 1
    assert clean.drop_nulls(trips, ["start_lat"]).count() == 2


def test_durations_and_columns(three_trips):
    out = clean.remove_outlier(clean.preprocess(three_trips))
    assert set(out.columns) == {
        "rideable_type", "started_at", "ended_at", "start_station_name", "end_station_name",
        "start_time", "end_time", "duration",
    }
    assert [r.duration for r in out.orderBy("started_at").collect()] == [12.5, 31.0, 7.0]


def test_fractions_count_for_duration_only(spark):
    rows = [
        trip(str(i), "a", "b", "2024-01-01 08:00:01.900000", f"2024-01-01 08:0{i}:02.400000")
        for i in range(1, 4)
    ]
    out = clean.with_clock_and_duration(clean.preprocess(spark.createDataFrame(rows, TRIP)))
    first = out.orderBy("ended_at").first()
    assert first.start_time == 8 + 1 / 3600
    assert first.duration == pytest.approx(60.5 / 60)


@pytest.mark.parametrize("n", [1, 3])
def test_no_spread_drops_all_without_an_error(spark, n):
    rows = [trip(str(i), "a", "b", "2024-01-01 08:00:00", "2024-01-01 08:10:00") for i in range(n)]
    kept = clean.remove_outlier(clean.preprocess(spark.createDataFrame(rows, TRIP)))
    assert kept.count() == 0


def test_outliers_are_cut_at_two_deviations(spark):
    rows = [
        trip(str(i), "a", "b", "2024-01-01 08:00:00", f"2024-01-01 08:{10 + i % 3}:00")
        for i in range(30)
    ] + [trip("long", "a", "b", "2024-01-01 08:00:00", "2024-01-01 20:00:00")]
    trips = clean.preprocess(spark.createDataFrame(rows, TRIP))
    assert clean.remove_outlier(trips).count() == 30
    assert clean.duration_outliers(trips).count() == 1


def test_mixed_timestamps_parse(spark):
    texts = ["2024-01-01 08:00:00", "2024-01-01 08:00:00.25", "2024-01-01 08:00:00.5 UTC", "at eight"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = frame.select(clean.parse_timestamp("t", strict=False).alias("p"))
    assert [r.p for r in parsed.collect()] == [
        ts("2024-01-01 08:00:00"), ts("2024-01-01 08:00:00.250000"), ts("2024-01-01 08:00:00.500000"), None,
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame.select(clean.parse_timestamp("t")).collect()


def test_one_day_has_the_columns_and_no_rows(three_trips):
    stock = elt.build_stock(three_trips)
    assert set(stock.columns) == {"time", "station", "rideable_type", "stock"}
    assert stock.count() == 0
    table = elt.build_features(three_trips)
    assert table.columns == [
        "station", "rideable_type", "stock", "hour", "dayofweek", "is_rush_hour", "lag_15m_stock",
        "lag_30m_stock", "lag_45m_stock", "lag_60m_stock", "target_next_stock", "date",
    ]
    assert table.count() == 0


def test_observed_pairs_become_columns(three_trips):
    wide = elt.stock_series(clean.remove_outlier(clean.preprocess(three_trips)), skip_days=0)
    assert reshape.series_names(wide) == [
        "Mill|classic_bike", "Mill|electric_bike", "Pier|classic_bike", "Pier|electric_bike",
    ]


@pytest.fixture(scope="module")
def midnight_stock(midnight_trips):
    cleaned = clean.with_clock_and_duration(clean.preprocess(midnight_trips))
    return elt.stock_series(cleaned).cache()


def test_a_last_bin_at_midnight_is_lost(midnight_stock):
    sums = {
        r.station: (r.n, r.total, r.lo, r.hi)
        for r in midnight_stock.groupBy("station")
        .agg(
            F.count("*").alias("n"), F.sum("stock").alias("total"),
            F.min("time").alias("lo"), F.max("time").alias("hi"),
        )
        .collect()
    }
    span = (ts("2024-01-02 00:00:00"), ts("2024-01-02 23:45:00"))
    assert sums == {"St1": (96, 896, *span), "St2": (96, 1022, *span)}


def test_stock_counts_its_own_slot(midnight_stock):
    def at(station, time):
        row = midnight_stock.where((F.col("station") == station) & (F.col("time") == ts(time)))
        return row.first().stock

    assert at("St1", "2024-01-02 07:45:00") == 10
    assert at("St1", "2024-01-02 08:00:00") == 9
    assert at("St2", "2024-01-02 08:00:00") == 10
    assert at("St2", "2024-01-02 08:15:00") == 11
    assert at("St2", "2024-01-02 23:45:00") == 10


def test_features_lose_five_slots_per_series(midnight_stock):
    table = features.features(midnight_stock)
    assert table.count() == 182
    assert all(r["count"] == 91 for r in table.groupBy("station").count().collect())


def test_a_series_seen_only_in_the_lost_bin_stays_at_its_initial_stock(spark):
    rows = [
        trip("A", "St1", "St2", "2024-01-01 08:00:00", "2024-01-02 08:10:00"),
        trip("B", "St1", "St3", "2024-01-02 08:00:00", "2024-01-03 00:00:00"),
    ]
    stock = elt.stock_series(clean.preprocess(spark.createDataFrame(rows, TRIP)), top_n=None)
    lone = stock.where("station = 'St3'")
    assert lone.count() == 96
    assert lone.select("stock").distinct().collect() == [(10,)]


def test_rush_hours_differ_at_the_closing_edge(spark):
    times = ["07:45", "08:00", "10:00", "10:15", "17:00", "19:00", "19:15"]
    rows = [(ts(f"2024-01-01 {t}:00"), "a", "classic_bike", 1) for t in times]
    stock = spark.createDataFrame(rows, "time timestamp_ntz, station string, rideable_type string, stock long")
    closed = features.calendar_features(stock).orderBy("time").collect()
    half_open = features.calendar_features(stock, rush="half_open").orderBy("time").collect()
    assert [r.is_rush_hour for r in closed] == [0, 1, 1, 0, 1, 1, 0]
    assert [r.is_rush_hour for r in half_open] == [0, 1, 0, 0, 1, 0, 0]
    assert {r.dayofweek for r in closed} == {0}


def test_scaled_date_is_zero_to_one_over_the_first_year(spark):
    rows = [(ts(t), "a", "b", 1) for t in ("2024-01-01 05:00:00", "2024-12-31 05:00:00", "2025-01-01 05:00:00")]
    stock = spark.createDataFrame(rows, "time timestamp_ntz, station string, rideable_type string, stock long")
    dates = [r.date for r in features.calendar_features(stock).orderBy("time").collect()]
    assert dates == [0.0, 365 / 366, 1.0]


def brute_force_stock(trips, top):
    """Stock in plain Python from (station, type, time, flow) tuples."""
    flows = [(s, k, a, -1) for s, _, k, a, _ in trips if s in top]
    flows += [(e, k, b, 1) for _, e, k, _, b in trips if e in top]
    slot = lambda t: t.replace(minute=t.minute - t.minute % 15, second=0, microsecond=0)
    slots = [slot(t) for _, _, t, _ in flows]
    midnight = lambda t: t.replace(hour=0, minute=0)
    lo, hi = midnight(min(slots)), max(slots)
    hi = hi if hi == midnight(hi) else midnight(hi) + timedelta(days=1)
    net = {}
    for (s, k, _, f), t in zip(flows, slots, strict=True):
        net[s, k, t] = net.get((s, k, t), 0) + f
    out = set()
    for s, k in {(s, k) for s, k, _ in net}:
        t, level = lo, 10
        while t < hi:
            level = 10 if t == midnight(t) else level
            level += net.get((s, k, t), 0)
            if t >= lo + timedelta(days=1):
                out.add((t, s, k, level))
            t += timedelta(minutes=15)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stock_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    trips = []
    for _ in range(120):
        start = datetime(2024, 3, 1) + timedelta(minutes=draw.randrange(5 * 24 * 60))
        end = start + timedelta(minutes=draw.randrange(1, 90))
        trips.append((draw.choice("abcde"), draw.choice("abcde"), draw.choice(["x", "y"]), start, end))
    columns = "start_station_name string, end_station_name string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz"
    frame = spark.createDataFrame(trips, columns)
    counts = {s: sum(t[0] == s for t in trips) for s in "abcde"}
    top = sorted(counts, key=lambda s: (-counts[s], s))[:3]
    for stations_, names in ((None, top), (["b", "e"], ["b", "e"])):
        got = elt.stock_series(frame, stations_).collect()
        assert {tuple(r) for r in got} == brute_force_stock(trips, names)
        assert len(got) == len({tuple(r) for r in got})


def test_ties_for_the_last_place_go_by_name(spark):
    names = ["d", "d", "c", "b", "a", "a"]
    rows = [trip(str(i), s, s, "2024-01-01 08:00:00", "2024-01-01 08:10:00") for i, s in enumerate(names)]
    trips = spark.createDataFrame(rows, TRIP)
    expected = ["a", "d", "b"]
    assert [r.station for r in stations.top_stations_by_starts(trips).collect()] == expected
    assert [r.station for r in stations.top_stations_by_both(trips).collect()] == expected


def test_a_null_start_stays_when_the_end_is_busy(spark):
    rows = [
        trip("A", None, "top", "2024-01-01 08:00:00", "2024-01-01 08:10:00"),
        trip("B", None, "other", "2024-01-01 08:00:00", "2024-01-01 08:10:00"),
        trip("C", "top", None, "2024-01-01 08:00:00", "2024-01-01 08:10:00"),
    ]
    trips = spark.createDataFrame(rows, TRIP)
    top = spark.createDataFrame([("top",)], "station string")
    assert {r.ride_id for r in stations.trips_touching(trips, top).collect()} == {"A", "C"}


def test_one_years_stations_select_another_years_trips(spark, midnight_trips):
    other = spark.createDataFrame(
        [
            trip("X", "St9", "St8", "2025-01-01 08:00:00", "2025-01-01 08:10:00"),
            trip("Y", "St1", "St8", "2025-01-01 08:00:00", "2025-01-01 08:10:00"),
        ],
        TRIP,
    )
    from flowtide.session import shared_path

    models = elt.publish_models(spark, {2024: midnight_trips, 2025: other}, 2024, shared_path(spark, "marts"))
    assert {r.ride_id for r in models["fct_2025_top_trips"].collect()} == {"Y"}
    assert models["fct_2024_top_trips"].count() == 3
    assert spark.table("stg_trips_2025").count() == 2


def test_wide_and_long_are_inverse(spark, midnight_stock):
    wide = reshape.long_to_wide(midnight_stock)
    back = reshape.wide_to_long(wide)
    assert sorted(back.collect()) == sorted(midnight_stock.collect())


def test_dense_net_flow_sums_to_the_flows(spark, midnight_trips):
    flows = stations.station_flows(clean.preprocess(midnight_trips))
    dense = series.dense_net_flow(series.net_flow(flows))
    assert dense.count() == 2 * 2 * 96
    # the flow in the lost slot is missing
    assert dense.agg(F.sum("net_flow")).first()[0] == flows.agg(F.sum("flow")).first()[0] - 1


def test_stock_options(spark, midnight_trips):
    trips = clean.preprocess(midnight_trips)
    hourly = elt.stock_series(trips, slot_minutes=60, initial_stock=5, skip_days=0)
    assert hourly.where("station = 'St1'").count() == 48
    assert hourly.agg(F.max("stock")).first()[0] <= 7
    table = features.features(hourly, lags=2, slot_minutes=60)
    assert "lag_60m_stock" in table.columns and "lag_120m_stock" in table.columns
