"""The plans Spark makes of the operators: shuffles, scans, joins."""

import re
from datetime import datetime, timedelta

import pytest
from conftest import trip
from pyspark.sql import functions as F

from checks.queries import QUERIES
from flowtide.operators import clean, features, requests, series, stations
from flowtide.plans import elt
from flowtide.schemas import TRIP
from flowtide.session import materialize, shared_path
from flowtide.sources import tables
from flowtide.sources.events import trips_from_events


def final_plan(df) -> str:
    """The adaptive plan after the last row."""
    df.collect()
    return planned(df)


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trips(spark):
    start = datetime(2024, 3, 1)
    rows = [
        trip(str(i), "abcde"[i % 5], "abcde"[i * 3 % 5], str(start + timedelta(minutes=37 * i)),
             str(start + timedelta(minutes=37 * i + 5 + i % 7)))
        for i in range(300)
    ]
    return materialize(spark.createDataFrame(rows, TRIP), "plan-trips")


def test_features_pass_over_the_trips_three_times(trips):
    table = elt.build_features(trips)
    before = planned(table)
    assert "CartesianProduct" not in before and "NestedLoop" not in before
    # one shuffle by series feeds the fill, the daily sums and the lags
    assert before.count("REPARTITION_BY_COL") == 1
    assert before.split("REPARTITION_BY_COL")[0].count("Window [") == 3
    # duration statistics, busiest stations, net flow; the grid bounds reuse the
    # shuffle of the net flow, so they scan nothing
    after = final_plan(table)
    assert "ReusedExchange" in after and "ReusedSubquery" in after


def test_net_flow_combines_before_the_shuffle(trips):
    plan = planned(series.net_flow(stations.station_flows(clean.preprocess(trips), ["a"])))
    exchange = plan.index("Exchange hashpartitioning(")
    assert "partial_sum(flow" in plan[exchange:]
    assert plan.count("Exchange ") == 1


def test_top_stations_sort_no_table(trips):
    plan = planned(stations.top_stations_by_starts(trips))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert re.search(r"ReadSchema: struct<start_station_name:string>", plan)


def test_touching_trips_shuffle_no_trips(trips):
    plan = planned(stations.trips_touching(trips, stations.top_stations_by_both(trips)))
    trunk = plan[: plan.index("BroadcastExchange")]
    assert plan.count("BroadcastHashJoin") == 2 and "ExistenceJoin" in plan
    assert "Exchange hashpartitioning(ride_id" not in trunk


def test_lags_and_target_share_one_window(trips):
    stock = elt.build_stock(trips)
    plan = planned(features.lag_features(materialize(stock, "plan-stock")))
    assert plan.count("Window [") == 1 and plan.count("Exchange ") == 1


def test_requests_prune_the_stored_days(spark, trips):
    path = shared_path(spark, "plan-stock-by-day")
    tables.write_stock(elt.build_stock(trips), path)
    history = tables.read_stock(spark, path, with_day=True)
    asked = trips.select(
        F.col("start_station_name").alias("station"), "rideable_type", F.to_date("started_at").alias("target_day")
    ).where("target_day = DATE '2024-03-04'")
    sliced = requests.score_slice(asked, history)
    assert "dynamicpruning" in planned(sliced)
    assert sliced.count() % 96 == 0 and sliced.count() > 0


def test_pairing_events_shuffles_them_once(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=40 * i), i % 7, f"e{i % 3}") for i in range(500)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    plan = final_plan(trips_from_events(materialize(events, "plan-events")))
    assert "ReusedExchange" in plan


@pytest.mark.parametrize(
    "name",
    ["remove_outlier", "stock_all_stations", "time_split", "seasonal_decompose", "drift_numeric",
     "stockout_alerts", "minmax_scale", "hist_start_time", "upsert_orders_partial", "naive_rmse"],
)
def test_no_cross_joins(spark, name):
    plan = planned(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
