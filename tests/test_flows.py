"""Files, tables, training, scoring, monitoring and streams end to end."""

import io
import random
import zipfile
from datetime import date, datetime, timedelta

import pytest
from conftest import trip, ts
from pyspark.sql import functions as F

from flowtide.operators import clean, models, requests, reshape, series, split, stations
from flowtide.operators.features import features
from flowtide.plans import elt, monitoring, scoring, training
from flowtide.schemas import MODEL_PERFORMANCE, TRIP
from flowtide.session import list_folders, shared_path
from flowtide.sources import tables, trip_files
from flowtide.streaming import alerts as alert_stream
from flowtide.streaming import daily_stock
from flowtide.streaming import net_flow as net_flow_stream

HEADER = ",".join(TRIP.names)
LINES = [
    'A,classic_bike,2024-01-01 08:00:00,2024-01-01 08:10:00,"W 1 St, North",1,St2,2,40.1,-73.1,40.2,-73.2,member',
    "B,electric_bike,2024-01-01 09:00:00.25,2024-01-01 09:15:00.5,St1,1,,,40.1,-73.1,,,casual",
]


def test_csv_by_year(spark, tmp_path):
    (tmp_path / "202401-trips.csv").write_text("\n".join([HEADER, LINES[0]]) + "\n")
    (tmp_path / "202402-trips.csv").write_text("\n".join([HEADER, LINES[1]]) + "\n")
    (tmp_path / "202501-trips.csv").write_text("\n".join([HEADER, LINES[1]]) + "\n")
    trips = trip_files.read_trips_csv(spark, str(tmp_path), year=2024)
    assert trips.schema == TRIP
    a, b = trips.orderBy("ride_id").collect()
    assert (a.start_station_name, a.end_lat) == ("W 1 St, North", 40.2)
    assert (b.started_at, b.end_station_name, b.end_lat) == (ts("2024-01-01 09:00:00.250000"), None, None)


def test_zips_equal_their_csvs(spark, tmp_path):
    for month, line in enumerate(LINES, 1):
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as archive:
            archive.writestr(f"2024{month:02d}-trips.csv", f"{HEADER}\n{line}\n")
            archive.writestr(f"__MACOSX/2024{month:02d}-trips.csv", "rubbish")
            archive.writestr("readme.txt", "rubbish")
        (tmp_path / f"2024{month:02d}.zip").write_bytes(content.getvalue())
    (tmp_path / "all.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    from_zip = trip_files.read_trip_zips(spark, str(tmp_path))
    from_csv = trip_files.read_trips_csv(spark, str(tmp_path / "all.csv"))
    assert from_zip.schema == TRIP
    assert sorted(map(repr, from_zip.collect())) == sorted(map(repr, from_csv.collect()))


def test_every_archive_has_its_own_task(spark, tmp_path):
    for part in range(8):
        with zipfile.ZipFile(tmp_path / f"{part}.zip", "w") as archive:
            archive.writestr("trips.csv", f"{HEADER}\n{LINES[0]}\n")
    rows = trip_files.read_trip_zips(spark, str(tmp_path))
    tasks = rows.select(F.spark_partition_id().alias("task")).collect()
    assert len(tasks) == 8 == len({r.task for r in tasks})


def test_good_and_rejected_lines_are_all_lines(spark, tmp_path):
    head = ",".join(f.name for f in TRIP)
    fields = ["r1", "classic_bike", "2024-01-01 08:00:00", "2024-01-01 08:10:00.5", "a", "1", "b", "2", "1.5", "2.5", "", "4.5", "member"]
    lines = [
        ",".join(fields),
        ",".join([*fields[:2], "at eight", *fields[3:8], "north", *fields[9:]]),
        "r3,classic_bike",
        ",".join([*fields, "more"]),
        "",
    ]
    (tmp_path / "2024-01.csv").write_text("\n".join([head, *lines]) + "\n")
    (tmp_path / "2023-01.csv").write_text(head + "\n")
    checked = trip_files.check_trips_csv(spark, str(tmp_path), year=2024)
    good = trip_files.good_trips(checked).collect()
    assert [(r.ride_id, r.end_lat, r.end_lng) for r in good] == [("r1", None, 4.5)]
    rejected = {r.reason: (r.line, r.file) for r in trip_files.rejected_lines(checked).collect()}
    assert set(rejected) == {"columns", "started_at,start_lat"} and len(good) + checked.where("reason IS NOT NULL").count() == 4
    assert rejected["started_at,start_lat"][0] == lines[1]
    assert all(file.endswith("2024-01.csv") for _, file in rejected.values())
    assert trip_files.check_trips_csv(spark, str(tmp_path), year=2023).count() == 0


def test_refresh_and_append(spark, three_trips):
    path = shared_path(spark, "year")
    trip_files.load_year(three_trips, path)
    trip_files.load_year(three_trips, path)
    assert spark.read.parquet(path).count() == 3
    trip_files.append_trips(three_trips, path)
    assert spark.read.parquet(path).count() == 6


def busy_trips(spark, days=12, n=1500, seed=4, year=2024):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        start = datetime(year, 3, 1) + timedelta(seconds=draw.randrange(days * 86400))
        end = start + timedelta(seconds=draw.randrange(60, 3600))
        a, b = draw.choices("abcd", weights=[6, 3, 2, 1])[0], draw.choice("abcd")
        kind = draw.choice(["classic_bike", "electric_bike"])
        rows.append(trip(str(i), a, b, start.isoformat(" "), end.isoformat(" "), kind))
    return spark.createDataFrame(rows, TRIP)


@pytest.fixture(scope="module")
def stock(spark):
    path = shared_path(spark, "test-stock")
    tables.write_stock(elt.build_stock(busy_trips(spark)), path)
    return tables.read_stock(spark, path)


@pytest.fixture(scope="module")
def trained(spark, stock):
    """Two runs; the first is the better one."""
    root = shared_path(spark, "test-training")
    table = features(stock, keep_time=True)
    good = training.train_and_promote(table, root, rounds=4, depth=3)
    poor = training.train_and_promote(table, root, rounds=1, depth=1)
    return root, good, poor


def test_stored_stock_reads_one_day_only(spark, stock):
    assert stock.columns == ["time", "station", "rideable_type", "stock"]
    assert stock.groupBy("station", "rideable_type", F.to_date("time")).count().where("count <> 96").count() == 0


def test_wide_csv_round_trip(spark, stock):
    path = shared_path(spark, "wide")
    tables.write_wide_csv(stock, path)
    assert sorted(tables.read_wide_csv(spark, path).collect()) == sorted(stock.collect())


def test_stored_features(spark, stock):
    for keep_time in (False, True):
        table = features(stock, keep_time=keep_time)
        path = shared_path(spark, "stored-features")
        tables.write_features(table, path)
        stored = tables.read_features(spark, path, with_time=keep_time)
        assert stored.columns == table.columns
        assert sorted(stored.collect()) == sorted(table.collect())


def test_deep_trees(spark, stock):
    table = features(stock.where("time < '2024-03-05'"))
    model = models.fit_gbt(table, **models.EXPERIMENT | {"rounds": 2})
    assert models.evaluate(models.score(model, table)).first().r2 > 0.2


def test_better_run_is_champion(spark, stock, trained):
    root, (good, good_rmse, promoted), (_, poor_rmse, not_promoted) = trained
    assert good_rmse < poor_rmse
    assert promoted and not not_promoted
    runs = training.read_runs(spark, root)
    assert runs.count() == 2 and training.best_run(runs).first().run_id == good
    table = features(stock, keep_time=True)
    held_out = split.test_rows(table)
    again = models.evaluate(training.score_with_champion(spark, root, held_out)).first()
    assert again.rmse == pytest.approx(good_rmse)
    assert again.mse == pytest.approx(good_rmse**2)
    assert again.mae <= again.rmse <= again.max_error


def test_more_stations_than_bins_and_an_unseen_one(spark, stock):
    table = features(stock).drop("station")
    numbered = table.withColumn("station", F.concat(F.lit("s"), F.monotonically_increasing_id() % 1000))
    model = models.fit_gbt(numbered, rounds=1, depth=2)
    asked = numbered.limit(5).unionByName(numbered.limit(2).withColumn("station", F.lit("new"))).unionByName(
        numbered.limit(1).withColumn("lag_15m_stock", F.lit(None).cast("long"))
    )
    scored = models.score(model, asked)
    assert scored.count() == 8 and scored.where("prediction IS NULL").count() == 3
    row = models.evaluate(scored).first()
    assert (row.n, row.n_unscored) == (5, 3)


def test_importance_and_training_on_all_rows(spark, stock):
    table = features(stock)
    model, scored = training.fit_and_evaluate(table, train_fraction=None, rounds=2, depth=2)
    assert scored is None
    rows = models.feature_importance(model, table).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1)
    assert rows[0].feature == "stock" and {r.feature for r in rows} >= {"station", "hour", "lag_15m_stock"}


def test_random_search_is_seeded(spark, stock):
    table = features(stock, keep_time=True)
    options = {"draws": 2, "folds": 2, "rounds": (1, 3), "depths": (2, 4), "parallelism": 2}
    first, second = (models.random_search(table, **options) for _ in range(2))
    assert first.avgMetrics == pytest.approx(second.avgMetrics)
    assert models.score(first.bestModel, table).count() == table.count()


def test_alerts_from_the_champion(spark, stock, trained):
    model = training.load_champion(spark, trained[0])
    asked = spark.createDataFrame(
        [("a", "classic_bike", "2024-03-05"), ("a", "classic_bike", "2024-03-01"), ("zz", "classic_bike", "2024-03-05")],
        "station string, rideable_type string, target_date string",
    )
    valid = requests.valid_requests(requests.validate_requests(asked, ["a", "b", "c"], year=2024))
    answers = {str(r.target_day): r for r in scoring.stockout_alerts(valid, stock, model).collect()}
    assert set(answers) == {"2024-03-05", "2024-03-01"}
    assert answers["2024-03-01"].no_history and not answers["2024-03-01"].warning
    first_day = valid.withColumn("target_day", F.lit("2024-03-02").cast("date"))
    assert scoring.one_step_forecast(first_day, stock, model).count() == 96
    steps = scoring.one_step_forecast(valid, stock, model)
    assert steps.count() == 96
    unseen = spark.createDataFrame([("zz", "classic_bike", date(2024, 3, 5))], valid.select("station", "rideable_type", "target_day").schema)
    history = stock.where("station = 'a'").withColumn("station", F.lit("zz"))
    answer = scoring.stockout_alerts(unseen, history, model).first()
    assert answer.unscored and not answer.no_history and not answer.warning
    limit, expected = 0.0, []
    for r in steps.orderBy("time").collect():
        assert r.error == r.actual_stock - r.predicted_stock
        if r.predicted_stock < limit:
            expected.append(f"{r.time + timedelta(minutes=15):%Y-%m-%d %H:%M:%S}")
            limit -= 10
    assert answers["2024-03-05"].prediction == expected
    assert answers["2024-03-05"].warning == bool(expected)


def test_backfills_keep_what_was_reported(spark, stock, trained):
    root = shared_path(spark, "metrics")
    reference = features(stock)
    current = features(elt.build_stock(busy_trips(spark, days=6, n=500, seed=9, year=2025)))
    month = date(2025, 3, 1)
    monitoring.backfill_drift(spark, root, reference, current, month)
    read = {n: t.read() for n, t in tables.ensure_metric_tables(spark, root).items()}
    drift, summary = read["column_drift"], read["dataset_summary"]
    days = {datetime(2025, 3, d) for d in range(2, 8)}
    assert {r.timestamp for r in summary.collect()} == days
    assert drift.count() == 12 * len(days)
    moved = drift.where("column_name = 'date'").collect()
    assert all(r.is_drift for r in moved)
    first = sorted(map(repr, drift.collect()))
    # again with another reference: scores stay, of the summary only the number is refreshed
    monitoring.backfill_drift(spark, root, reference.where("stock > 12"), current, month)
    read = {n: t.read() for n, t in tables.ensure_metric_tables(spark, root).items()}
    assert sorted(map(repr, read["column_drift"].collect())) == first
    shares = {r.timestamp: r.share_of_drifted_columns for r in summary.collect()}
    assert {r.timestamp: r.share_of_drifted_columns for r in read["dataset_summary"].collect()} == shares

    model = training.load_champion(spark, trained[0])
    for _ in range(2):
        monitoring.backfill_performance(spark, root, model, current, month)
    table = tables.ensure_metric_tables(spark, root)["model_performance"]
    assert table.version() == 2
    rows = table.read().collect()
    assert {r.timestamp for r in rows} == days
    assert all(0 < r.mae <= r.rmse <= r.abs_error_max for r in rows)


def test_versions(spark):
    table = tables.VersionedTable(spark, shared_path(spark, "versions"), MODEL_PERFORMANCE)
    table.create_if_absent()
    table.create_if_absent()
    assert (table.version(), table.read().count()) == (0, 0)
    row = spark.createDataFrame([(ts("2024-01-01"), 1.0, 1.0, 1.0)], MODEL_PERFORMANCE)
    table.replace(row)
    table.replace(table.read().unionByName(row))
    assert (table.version(), table.read().count()) == (2, 2)


# --- streams -----------------------------------------------------------------------------


def arriving(spark, trips, parts):
    """Trips as a stream of several batches, in time order."""
    path = shared_path(spark, "arriving")
    rows = sorted(trips.collect(), key=lambda r: r.started_at)
    size = -(-len(rows) // parts)
    for i in range(parts):
        chunk = spark.createDataFrame(rows[i * size : (i + 1) * size], TRIP)
        chunk.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(TRIP).option("maxFilesPerTrigger", 1).parquet(path)
    return clean.preprocess(stream)


def test_net_flow_of_a_stream_in_batches(spark):
    trips = busy_trips(spark, days=3, n=300)
    flows = stations.station_flows(arriving(spark, trips, 4), top_n=None)
    path = shared_path(spark, "net")
    net_flow_stream.start_net_flow(flows, path, f"{path}-progress").awaitTermination()
    batch = series.net_flow(stations.station_flows(clean.preprocess(trips), top_n=None))
    got = net_flow_stream.read_net_flow(spark, path)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect()))
    days = list_folders(spark, path)
    assert days and all(len(list_folders(spark, f"{path}/{day}")) <= 2 for day in days)


def test_a_repeated_batch_counts_once(spark):
    path = shared_path(spark, "repeated")
    rows = [(ts("2024-01-01 08:00:00"), "a", "x", -1), (ts("2024-01-02 08:00:00"), "a", "x", 1)]
    flows = spark.createDataFrame(rows, "time timestamp_ntz, station string, rideable_type string, flow int")
    for number in (0, 1, 1, 2, 2):
        net_flow_stream.add_flows(flows, number, path)
    assert sorted(r.net_flow for r in net_flow_stream.read_net_flow(spark, path).collect()) == [-3, 3]


def test_daily_stock_of_a_stream_in_batches(spark):
    trips = busy_trips(spark, days=3, n=300)
    path = shared_path(spark, "daily")
    flows = stations.station_flows(arriving(spark, trips, 4), top_n=None)
    query = daily_stock.start_daily_stock(flows, path, f"{path}/progress")
    query.awaitTermination()
    got = {(r.time, r.station, r.rideable_type): r.stock for r in daily_stock.read_daily_stock(spark, path).collect()}
    batch = elt.stock_series(clean.preprocess(trips), top_n=None, skip_days=0)
    full = {(r.time, r.station, r.rideable_type): r.stock for r in batch.collect()}
    busy = series.net_flow(stations.station_flows(clean.preprocess(trips), top_n=None))
    keys = {(r.time, r.station, r.rideable_type) for r in busy.collect()}
    assert got == {k: full[k] for k in keys}


def test_alerts_of_a_stream_in_batches(spark):
    first = datetime(2024, 1, 1)
    draw = random.Random(2)
    level, rows = 0.0, []
    for i in range(2 * 96):
        level = draw.uniform(-2, 2) if i % 96 == 0 else level + draw.uniform(-2, 1.6)
        rows.append((first + timedelta(minutes=15 * i), "a", "x", level))
    schema = "time timestamp_ntz, station string, rideable_type string, prediction double"
    path = shared_path(spark, "predictions")
    for i in range(0, len(rows), 50):
        spark.createDataFrame(rows[i : i + 50], schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    table = shared_path(spark, "alerts")
    alert_stream.start_alerts(stream, table, f"{table}-progress").awaitTermination()
    got = alert_stream.read_alerts(spark, table).collect()
    expected = []
    for d in range(2):
        limit = 0.0
        for t, _, _, p in rows[d * 96 : (d + 1) * 96]:
            if p < limit:
                expected.append(f"{t + timedelta(minutes=15):%Y-%m-%d %H:%M:%S}")
                limit -= 10
    assert sorted(r.alert for r in got) == expected and expected


def test_wide_series_names_keep_separators(spark):
    frame = spark.createDataFrame(
        [(ts("2024-01-01"), "a|b", "x", 1)], "time timestamp_ntz, station string, rideable_type string, stock long"
    )
    assert reshape.wide_to_long(reshape.long_to_wide(frame)).collect() == frame.collect()
