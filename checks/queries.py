"""One query per operator, each over the whole of the given tables.

Trips, and the stock series made of them, are written once per session as tables
in the shared folder, as a user of the library would do; every query then starts
from one of them or from a given table.
"""

import zipfile
from collections.abc import Callable
from functools import partial

import pandas as pd
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.oracles import (
    DATES,
    EVENT_TYPES,
    LINE_NUMBERS,
    MAY_BE_MISSING,
    SHIFT,
    TYPES,
)
from flowtide.constants import CATEGORICAL_FEATURES, NUMERICAL_FEATURES, TARGET
from flowtide.operators import (
    boosting,
    clean,
    comoments,
    drift,
    drift_sketch,
    features,
    forecast,
    models,
    profile,
    requests,
    reshape,
    series,
    split,
    stations,
    upsert,
    var_groups,
)
from flowtide.plans import elt, monitoring, named_models, training
from flowtide.schemas import MODEL_PERFORMANCE, TRIP, TRIP_TEXT
from flowtide.session import materialize, shared_path, write_table
from flowtide.sources import tables, trip_files, zip_members
from flowtide.sources.events import read_events, trips_from_events
from flowtide.sources.keyed_table import KeyedTable
from flowtide.streaming import alerts as alert_stream
from flowtide.streaming import closing, daily_stock
from flowtide.streaming import net_flow as net_flow_stream
from flowtide.streaming import stateful

_paths: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def _path(spark: SparkSession, folder: str, name: str, build) -> tuple[str, StructType]:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _paths:
        table = build()
        _paths[key] = write_table(table, name), table.schema
    return _paths[key]


def _table(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    path, schema = _path(spark, folder, name, build)
    return spark.read.schema(schema).parquet(path)


def _stream(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    path, schema = _path(spark, folder, name, build)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _build_trips(spark, folder):
    return lambda: trips_from_events(read_events(spark, folder))


def _build_stock(spark, folder):
    return lambda: elt.build_stock(trips(spark, folder))


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "trips", _build_trips(spark, folder))


def stock(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "stock", _build_stock(spark, folder))


def stock_all(spark: SparkSession, folder: str) -> DataFrame:
    return _table(
        spark, folder, "stock_all", lambda: elt.build_stock(trips(spark, folder), top_n=None)
    )


def feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    return features.features(stock(spark, folder), keep_time=True)


def complete(spark: SparkSession, folder: str) -> DataFrame:
    return clean.preprocess(trips(spark, folder))


def kept(spark: SparkSession, folder: str) -> DataFrame:
    return clean.remove_outlier(complete(spark, folder))


def net(spark: SparkSession, folder: str) -> DataFrame:
    return series.net_flow(stations.station_flows(kept(spark, folder)))


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/lineitem.parquet")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        *[F.round(F.col(c) + SHIFT, 6).alias(c) if c in columns else c for c in df.columns]
    )


# --- sources and cleaning -----------------------------------------------------


def scan_trips(spark, folder):
    path = shared_path(spark, "trip-files")
    trip_files.write_csv(trips(spark, folder), f"{path}/2024-trips.csv")
    return trip_files.read_trips_csv(spark, path, year=2024)


def checked_trips(spark, folder):
    """Every trip as a good line, and as a broken one: good and rejected lines by reason."""
    path = shared_path(spark, "lines")
    fields = {f.name: F.col(f.name).cast("string") for f in TRIP}
    classic = F.col("rideable_type") == TYPES[0]
    spoilt = {
        "started_at": F.when(classic, "at eight").otherwise(fields["started_at"]),
        "end_lng": F.when(classic, fields["end_lng"]).otherwise("west"),
    }
    as_line = lambda columns: F.to_csv(F.struct(*[v.alias(c) for c, v in columns.items()]))
    lines = F.array(as_line(fields), as_line(fields | spoilt), F.concat("ride_id", F.lit(",short")))
    trips(spark, folder).select(F.explode(lines).alias("line")).write.text(path)
    checked = trip_files.check_trips_csv(spark, path, header=False)
    rejected = trip_files.rejected_lines(checked).select("reason", F.col("line").isNotNull().alias("has_line"))
    good = trip_files.good_trips(checked).select(F.lit("good").alias("reason"), F.lit(False).alias("has_line"))
    return good.unionByName(rejected).groupBy("reason", "has_line").agg(F.count("*").alias("n"))


def append_trips(spark, folder):
    path = shared_path(spark, "appended")
    for kind in TYPES:
        part = trips(spark, folder).where(F.col("rideable_type") == kind)
        trip_files.append_trips(part, path)
    return spark.read.schema(TRIP).parquet(path)


def refresh_trips(spark, folder):
    path = shared_path(spark, "refreshed")
    for _ in range(2):
        trip_files.load_year(trips(spark, folder), path)
    return spark.read.schema(TRIP).parquet(path)


def _published(spark, folder):
    """Two years of trips: the table's own, and the same a year later."""
    this = trips(spark, folder)
    year = F.expr("INTERVAL 366 DAYS")
    moved = this.withColumns({c: F.col(c) + year for c in ("started_at", "ended_at")})
    return elt.publish_models(spark, {2024: this, 2025: moved}, 2024, shared_path(spark, "marts"))


def publish_models(spark, folder):
    return _published(spark, folder)["fct_2024_top_trips"]


def publish_next_year(spark, folder):
    """The next year's trips at the busiest stations of the year before."""
    return _published(spark, folder)["fct_2025_top_trips"]


def published_stations(spark, folder):
    return _published(spark, folder)["int_top_stations"]


def published_staging(spark, folder):
    return _published(spark, folder)["stg_trips_2024"]


def grown_models(spark, folder):
    """A third model of a second: starts by station of a table that has grown in two runs."""
    mark = "started_at"
    graph = [
        named_models.Model("mart_starts", ["fct_trips"], stations.starts_by_station, "table"),
        named_models.Model("fct_trips", ["stg_trips"], lambda t: t.select(mark, "start_station_name"), "growing", mark),
        named_models.Model("stg_trips", ["raw"], clean.stage_trips),
    ]
    raw, root = trips(spark, folder), shared_path(spark, "named")
    middle = raw.select(F.to_timestamp_ntz(F.date_add(F.min(mark).cast("date"), 15).cast("string"))).scalar()
    for arrived in (raw.where(F.col(mark) <= middle), raw):
        built = named_models.run_models(spark, graph, {"raw": arrived}, root)
    return built["mart_starts"]


def stored_stock(spark, folder):
    path = shared_path(spark, "stored-stock")
    tables.write_stock(stock(spark, folder), path)
    return tables.read_stock(spark, path, with_day=True)


def stored_features(spark, folder):
    path = shared_path(spark, "stored-features")
    tables.write_features(build_features(spark, folder), path)
    return tables.read_features(spark, path)


def wide_csv(spark, folder):
    path = shared_path(spark, "wide")
    tables.write_wide_csv(stock_all(spark, folder), path)
    return tables.read_wide_csv(spark, path)


def metric_table(spark, folder):
    table = tables.VersionedTable(spark, shared_path(spark, "metrics"), MODEL_PERFORMANCE)
    table.create_if_absent()
    for part in _old_and_new_performance(spark, folder):
        table.replace(upsert.upsert_keep_first(table.read(), part, ["timestamp"]))
    return rounded(table.read(), "rmse", "mae", "abs_error_max")


ROWS_PER_ARCHIVE = 20_000


def zip_trips(spark, folder):
    """The trips as zip archives of several members in the shared folder, read back by member."""
    path, names = shared_path(spark, "zips"), TRIP_TEXT.names

    def pack(batches):
        place = f"{path}/{TaskContext.get().partitionId():06d}.zip"
        storage, place = pyarrow.fs.FileSystem.from_uri(place) if "://" in place else (pyarrow.fs.LocalFileSystem(), place)
        storage.create_dir(path.split("://", 1)[-1], recursive=True)
        # one batch a member: nothing longer is held
        with storage.open_output_stream(place) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as packed:
            packed.writestr("__MACOSX/trips.csv", "rubbish")
            for number, rows in enumerate(batches):
                packed.writestr(f"trips-{number}.csv", "\n".join([",".join(names), *rows["line"]]) + "\n")
        yield pd.DataFrame({"archive": [place]})

    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    rows = trips(spark, folder)
    archives = -(-rows.count() // ROWS_PER_ARCHIVE) or 1
    lines = rows.select(F.concat_ws(",", *fields).alias("line")).repartition(archives, "line")
    lines.mapInPandas(pack, "archive string").write.format("noop").mode("overwrite").save()
    return zip_members.read_zip_members(spark, path)


def stg_trips(spark, folder):
    raw = trips(spark, folder)
    return clean.stage_trips(raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]))


def parse_ts(spark, folder):
    text = F.col("ts").cast("string")
    forms = {
        "fraction": text,
        "plain": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "zone": F.concat(text, F.lit(" UTC")),
        "bad": F.concat(F.lit("at "), text),
    }
    options = F.array(*[F.struct(F.lit(k).alias("form"), v.alias("text")) for k, v in forms.items()])
    mixed = read_events(spark, folder).select("event_id", F.explode(options).alias("o"))
    return mixed.select(
        "event_id", "o.form", clean.parse_timestamp("o.text", strict=False).alias("parsed")
    )


def drop_nulls(spark, folder):
    return clean.drop_nulls(trips(spark, folder))


def drop_nulls_subset(spark, folder):
    return clean.drop_nulls(trips(spark, folder), ["start_station_name", "end_lat"])


def duration_stats(spark, folder):
    return rounded(clean.duration_stats(complete(spark, folder)), "mean_duration", "std_duration")


def duration_outliers(spark, folder):
    return clean.duration_outliers(complete(spark, folder))


# --- stations and series --------------------------------------------------------


def starts_by_station(spark, folder):
    return stations.starts_by_station(trips(spark, folder))


def ends_by_station(spark, folder):
    return stations.ends_by_station(trips(spark, folder))


def top_stations_both(spark, folder):
    return stations.top_stations_by_both(trips(spark, folder))


def top_stations_starts(spark, folder):
    return stations.top_stations_by_starts(kept(spark, folder))


def top_station_trips(spark, folder):
    return stations.trips_touching(trips(spark, folder), top_stations_both(spark, folder))


def station_flows(spark, folder):
    return stations.station_flows(kept(spark, folder))


def net_flow_all_stations(spark, folder):
    return series.net_flow(stations.station_flows(kept(spark, folder), top_n=None))


def grid_bounds(spark, folder):
    return series.grid_bounds(net(spark, folder))


def time_grid(spark, folder):
    return series.time_grid(net(spark, folder))


def dense_net_flow(spark, folder):
    return series.dense_net_flow(net(spark, folder))


def stock_series(spark, folder):
    return elt.build_stock(trips(spark, folder))


def stock_all_stations(spark, folder):
    return elt.build_stock(trips(spark, folder), top_n=None)


SERIES_NAMES = [f"{s}|{t}" for s in EVENT_TYPES for t in TYPES]


def stock_wide(spark, folder):
    return reshape.long_to_wide(stock_all(spark, folder), SERIES_NAMES)


def wide_to_long(spark, folder):
    return reshape.wide_to_long(reshape.long_to_wide(stock_all(spark, folder)))


# --- features ---------------------------------------------------------------------


def calendar_features(spark, folder):
    return features.calendar_features(stock(spark, folder))


def calendar_features_scoring(spark, folder):
    return features.calendar_features(stock(spark, folder), rush="half_open")


def lag_features(spark, folder):
    return features.lag_features(stock(spark, folder))


def build_features(spark, folder):
    return elt.build_features(trips(spark, folder))


def time_split(spark, folder):
    # the split passes over its rows more than once, so they are stored first
    return split.ordered_split(materialize(feature_rows(spark, folder), "features"))


def stock_diff(spark, folder):
    return features.stock_diff(stock(spark, folder))


def one_hot(spark, folder):
    return features.one_hot(
        complete(spark, folder).drop("end_station_name"),
        {"start_station_name": None, "rideable_type": None},
    )


def minmax_scale(spark, folder):
    table = features.calendar_features(stock(spark, folder))
    scaled = features.min_max_scale(table, ["stock", "hour"])
    return rounded(scaled.select("time", "station", "rideable_type", "stock", "hour"), "stock", "hour")


def minmax_restore(spark, folder):
    table = stock(spark, folder)
    scaled = features.min_max_scale(table, ["stock"])
    return rounded(features.min_max_restore(scaled, ["stock"], fitted_on=table), "stock")


def sequences(spark, folder):
    windows = features.sequences(feature_rows(spark, folder), ["stock", "hour", "date"])
    text = lambda name: F.array_join(F.transform("window", lambda w: w[name].cast("string")), ",")
    total = lambda name: F.aggregate("window", F.lit(0.0), lambda s, w: s + w[name])
    table = windows.select(
        "time", "station", "rideable_type", text("stock").alias("stocks"),
        total("hour").alias("hours"), total("date").alias("dates"), "target",
    )
    return rounded(table, "hours", "dates")


# --- profiles -----------------------------------------------------------------------


def feature_corr(spark, folder):
    table = profile.correlation(feature_rows(spark, folder), NUMERICAL_FEATURES)
    return rounded(table, "correlation")


def daily_corr(spark, folder):
    """The same matrix, merged from one row a day and pair."""
    rows = feature_rows(spark, folder)
    parts = materialize(comoments.partial_moments(rows, NUMERICAL_FEATURES, F.to_date("time")), "moments")
    daily = materialize(comoments.merge(parts, ["day"]), "daily-moments")
    table = comoments.correlations(comoments.merge(daily))
    named = table.select(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "correlation")
    return rounded(named, "correlation")


def unique_check(spark, folder):
    return profile.unique_check(trips(spark, folder), "ride_id")


def type_counts(spark, folder):
    return profile.value_counts(complete(spark, folder), "rideable_type")


def _edges(histogram: DataFrame) -> DataFrame:
    return rounded(histogram, "lower_edge", "upper_edge")


def hist_start_time(spark, folder):
    timed = clean.with_clock_and_duration(complete(spark, folder))
    return _edges(profile.histogram(timed, "start_time", bins=24))


def hist_end_time(spark, folder):
    timed = clean.with_clock_and_duration(complete(spark, folder))
    return _edges(profile.histogram(timed, "end_time", bins=24))


def hist_duration(spark, folder):
    return _edges(profile.histogram(kept(spark, folder), "duration", width=60.0))


def trip_profile(spark, folder):
    return profile.profile(trips(spark, folder))


def null_counts(spark, folder):
    return profile.null_counts(trips(spark, folder))


def rows_with_nulls(spark, folder):
    return profile.rows_with_nulls(trips(spark, folder))


def mixed_types(spark, folder):
    columns = [f.name for f in TRIP if f.dataType.simpleString() == "string"]
    return profile.mixed_types(trips(spark, folder), columns)


def profile_lines(spark, folder):
    lines = line_items(spark, folder)
    # a type's name depends on who reads the file: both times are without a zone here
    return profile.profile(lines.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")))


def hist_line_prices(spark, folder):
    return _edges(profile.histogram(line_items(spark, folder), "l_extendedprice", bins=50))


def corr_lines(spark, folder):
    return rounded(profile.correlation(line_items(spark, folder), LINE_NUMBERS), "correlation")


# --- forecasts and models -----------------------------------------------------------


def naive_rmse(spark, folder):
    return rounded(forecast.overall_rmse(forecast.naive_forecast(stock(spark, folder))), "rmse")


def naive_rmse_by_series(spark, folder):
    return rounded(forecast.rmse_by_series(forecast.naive_forecast(stock(spark, folder))), "rmse")


def best_run(spark, folder):
    runs = None
    for k in range(1, 5):
        error = forecast.overall_rmse(forecast.naive_forecast(stock(spark, folder), lag=k))
        run = error.select(
            F.lit(f"naive_lag_{k}").alias("run_id"),
            F.create_map(F.lit(training.METRIC), "rmse").alias("metrics"),
        )
        runs = run if runs is None else runs.unionByName(run)
    best = training.best_run(runs)
    return best.select("run_id", F.round(F.col("metrics")[training.METRIC] + SHIFT, 6).alias("test_rmse"))


def seasonal_decompose(spark, folder):
    parts = forecast.seasonal_decompose(stock(spark, folder))
    return rounded(parts, "trend", "seasonal", "residual")


def _total_stock(spark, folder):
    """One series: the stock of all stations and types together."""
    total = stock(spark, folder).groupBy("time").agg(F.sum("stock").alias("stock"))
    return total.select("time", F.lit("all").alias("station"), F.lit("all").alias("rideable_type"), "stock")


def var_total(spark, folder):
    """One lag of one series: the fit has a closed form."""
    series_ = materialize(_total_stock(spark, folder), "total")
    model = forecast.fit_var(series_, max_lags=1)
    return rounded(forecast.var_summary(series_, model), "aic", "bic")


def var_total_forecast(spark, folder):
    series_ = materialize(_total_stock(spark, folder), "total")
    return rounded(forecast.var_forecast(series_, forecast.fit_var(series_, max_lags=1)), "predicted")


def var_fit(spark, folder):
    series_ = stock(spark, folder)
    return forecast.var_criteria(series_, forecast.fit_var(series_))


def _var_forecast(spark, folder):
    series_ = stock(spark, folder)
    return forecast.var_forecast(series_, forecast.fit_var(series_))


def var_forecast(spark, folder):
    return _var_forecast(spark, folder)


def var_rmse_by_series(spark, folder):
    return forecast.rmse_by_series(_var_forecast(spark, folder))


VAR_ORDER = 2


def var_groups_fit(spark, folder):
    """A vector autoregression of the types of every station: all coefficients as rows."""
    model = var_groups.fit_groups(stock(spark, folder), order=VAR_ORDER)
    return rounded(var_groups.coefficients(model), "weight")


def var_groups_forecast(spark, folder):
    series_ = stock(spark, folder)
    model = materialize(var_groups.fit_groups(series_, order=VAR_ORDER), "var-groups")
    return rounded(var_groups.forecast_groups(series_, model, max_lags=VAR_ORDER), "predicted")


def gbt_fit_score(spark, folder):
    return models.evaluate(training.fit_and_evaluate(feature_rows(spark, folder))[1])


def naive_metrics(spark, folder):
    """The metric set of the models, of the forecast that nothing changes."""
    scored = feature_rows(spark, folder).withColumn("prediction", F.col("stock").cast("double"))
    return rounded(models.evaluate(scored), "rmse", "mse", "mae", "max_error", "r2")


STUMP = {"rounds": 1, "depth": 1, "inputs": [*CATEGORICAL_FEATURES, "is_rush_hour"]}


def _stump_rows(spark, folder):
    """All series together, slot by slot: the rush hour flag is all that a tree can use."""
    slots = feature_rows(spark, folder).groupBy("time").agg(
        F.max("is_rush_hour").alias("is_rush_hour"), F.max("date").alias("date"), F.sum(TARGET).alias(TARGET)
    )
    return slots.withColumns({c: F.lit("all") for c in CATEGORICAL_FEATURES})


def _by_rush(scored):
    squared = F.pow(F.col(TARGET) - F.col("prediction"), 2)
    table = scored.groupBy("is_rush_hour").agg(
        F.count("prediction").alias("n_rows"),
        F.avg("prediction").alias("prediction"),
        F.sqrt(F.avg(squared)).alias("rmse"),
    )
    return rounded(table, "prediction", "rmse")


def gbt_stump(spark, folder):
    """One tree of one split: its predictions are the means of two groups."""
    table = materialize(_stump_rows(spark, folder), "features")
    return _by_rush(models.score(models.fit_gbt(table, **STUMP), table))


def gbt_stump_importance(spark, folder):
    table = materialize(_stump_rows(spark, folder), "features")
    return models.feature_importance(models.fit_gbt(table, **STUMP), table)


def _trained(spark, folder) -> str:
    root = shared_path(spark, "models")
    training.train_and_promote(_stump_rows(spark, folder), root, **STUMP)
    return root


def champion_scores(spark, folder):
    """Train on the first part, log, save, promote, load, and score the held-out rows."""
    held_out = split.test_rows(_stump_rows(spark, folder))
    return _by_rush(training.score_with_champion(spark, _trained(spark, folder), held_out))


def run_log(spark, folder):
    """The metrics of the run log after one run, and whether its model was kept."""
    root = _trained(spark, folder)
    runs = training.read_runs(spark, root)
    table = runs.select(
        F.col("metrics")[training.METRIC].alias("test_rmse"),
        F.col("params")["rounds"].alias("rounds"),
        F.col("params")["depth"].alias("depth"),
        F.col("model_path").isNotNull().alias("has_model"),
    )
    return rounded(table, "test_rmse")


def gbt_deep(spark, folder):
    """The deeper setting, with few rounds, on all stations and types."""
    model, scored = training.fit_and_evaluate(feature_rows(spark, folder), **models.EXPERIMENT | {"rounds": 3})
    return models.evaluate(scored)


def search_models(spark, folder):
    """Random search of two settings over two folds: the best setting's error."""
    found = models.random_search(
        feature_rows(spark, folder), draws=2, folds=2, rounds=(2, 4), depths=(2, 4), parallelism=2
    )
    return models.evaluate(models.score(found.bestModel, feature_rows(spark, folder)))


def gbt_importance(spark, folder):
    table = materialize(feature_rows(spark, folder), "features")
    return models.feature_importance(models.fit_gbt(table), table)


def _gappy(spark, folder):
    """The rush hour flag is missing where the stock is negative."""
    rush = F.when(F.col("stock") >= 0, F.col("is_rush_hour"))
    return feature_rows(spark, folder).select("time", *CATEGORICAL_FEATURES, TARGET, rush.alias("rush"))


def _by_cell(model, rows):
    table = boosting.score(model, rows).groupBy("rush", "rideable_type").agg(
        F.count("*").alias("n_rows"), F.avg("prediction").alias("prediction")
    )
    return rounded(table, "prediction")


def boosted_stump(spark, folder):
    """One split of a flag that may be missing, which the split sends where it fits best."""
    rows = _gappy(spark, folder)
    return _by_cell(boosting.fit_boosted(rows, rounds=1, depth=1, names=["rush"], categories=()), rows)


def boosted_depth2(spark, folder):
    """Two levels over the flag and the types: the second split may differ by side."""
    rows, names = _gappy(spark, folder), ["rush", "rideable_type"]
    return _by_cell(boosting.fit_boosted(rows, rounds=1, depth=2, names=names, categories=names[1:]), rows)


def _boosted(spark, folder):
    """The registered setting on the first part by time, lags missing where a series starts."""
    key = (spark.sparkContext.applicationId, folder, "boosted")
    rows = split.ordered_split(
        _table(spark, folder, "open_features",
               lambda: features.features(stock(spark, folder), drop_null=False, keep_time=True))
    )
    if key not in _paths:
        path = shared_path(spark, "boosted")
        boosting.fit_boosted(rows.where("is_train")).save(spark, path)
        _paths[key] = path, rows.schema
    return boosting.load(spark, _paths[key][0]), rows.where("NOT is_train")


def boosted_fit_score(spark, folder):
    model, held_out = _boosted(spark, folder)
    return models.evaluate(boosting.score(model, held_out))


def boosted_importance(spark, folder):
    return boosting.importance(_boosted(spark, folder)[0], spark)


# --- requests -------------------------------------------------------------------------


def raw_requests(spark, folder):
    """Per start station, type and day: a good request and one of each bad kind."""
    day = F.to_date("started_at")
    asked = trips(spark, folder).select(
        F.col("start_station_name").alias("station"), "rideable_type", day.alias("day")
    ).distinct()
    date = F.col("day").cast("string")
    kinds = [
        ("station", "rideable_type", date),
        (F.lit("nowhere"), "rideable_type", date),
        ("station", F.lit("hovercraft"), date),
        ("station", "rideable_type", F.concat(F.lit("2023"), F.substring(date, 5, 6))),
        ("station", "rideable_type", F.lit("not-a-date")),
    ]
    options = [
        F.struct(
            (F.col(s) if isinstance(s, str) else s).alias("station"),
            (F.col(t) if isinstance(t, str) else t).alias("rideable_type"),
            d.alias("target_date"),
        )
        for s, t, d in kinds
    ]
    return asked.select(F.explode(F.array(*options)).alias("r")).select("r.*")


def validate_months(spark, folder):
    """The same requests and as many for December, where the last month is November."""
    december = F.concat(F.lit("2024-12-"), F.substring("target_date", 9, 2))
    asked = raw_requests(spark, folder)
    late = asked.where(F.col("target_date").startswith("2024-")).withColumn("target_date", december)
    known = top_stations_both(spark, folder)
    return requests.validate_requests(asked.unionByName(late), known, year=2024, max_month=11)


def validate_requests(spark, folder):
    known = top_stations_both(spark, folder)
    return requests.validate_requests(raw_requests(spark, folder), known, year=2024)


def parse_requests(spark, folder):
    fields = ["station", "rideable_type", "target_date"]
    none = F.lit(None).cast("string")
    as_json = F.struct(F.lit("json").alias("form"), F.to_json(F.struct(*fields)).alias("body"), *[none.alias(c) for c in fields])
    as_fields = F.struct(F.lit("fields").alias("form"), none.alias("body"), *fields)
    broken = F.struct(F.lit("broken").alias("form"), F.lit("{not json").alias("body"), *[none.alias(c) for c in fields])
    raw = raw_requests(spark, folder).select(F.explode(F.array(as_json, as_fields, broken)).alias("r"))
    return requests.parse_requests(raw.select("r.*"))


def _valid_requests(spark, folder):
    served = stations.top_stations_by_starts(kept(spark, folder))
    asked = kept(spark, folder).select(
        F.col("start_station_name").alias("station"),
        "rideable_type",
        F.to_date("started_at").cast("string").alias("target_date"),
    ).distinct()
    checked = requests.validate_requests(asked, served, year=2024)
    return requests.valid_requests(checked)


def score_slice(spark, folder):
    return requests.score_slice(_valid_requests(spark, folder), stock(spark, folder))


def score_error(spark, folder):
    rows = score_slice(spark, folder)
    return requests.score_error(rows.withColumn("prediction", F.col("lag_15m_stock")))


def stockout_alerts(spark, folder):
    asked = _valid_requests(spark, folder)
    scored = requests.score_slice(asked, stock(spark, folder)).withColumn("prediction", F.col("stock"))
    answers = requests.answer_requests(asked, requests.alert_times(scored))
    return answers.select(
        "station",
        "rideable_type",
        "target_day",
        F.array_join("prediction", ",").alias("prediction"),
        "warning",
        "no_history",
        "unscored",
    )


# --- monitoring -------------------------------------------------------------------------


def _drift_sides(spark, folder):
    """The first half of the days as reference, the others as current days."""
    table = drift.with_day(feature_rows(spark, folder)).drop("time")
    ends = table.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    middle = ends.select(F.date_add("first", F.floor(F.date_diff("last", "first") / 2).cast("int"))).scalar()
    return table.where(F.col("day") <= middle), table.where(F.col("day") > middle)


def _value_counts(spark, folder):
    return materialize(drift.value_counts_by_day(*_drift_sides(spark, folder)), "value-counts")


def daily_features(spark, folder):
    return rounded(drift.daily_features(feature_rows(spark, folder)), "mean_stock")


def month_days(spark, folder):
    months = trips(spark, folder).select(F.trunc("started_at", "month").alias("month")).distinct()
    return drift.month_days(months)


def drift_numeric(spark, folder):
    counts = _value_counts(spark, folder)
    return rounded(drift.numeric_drift(counts), "drift_score")


NEAR = 0.05


def drift_sketches(spark, folder):
    """Scores from the sketches of days, the reference merged from its days: whether near the exact ones."""
    reference, current = _drift_sides(spark, folder)
    made = lambda side, label: materialize(drift_sketch.sketches(side, NUMERICAL_FEATURES, F.col("day")), label)
    merged = materialize(drift_sketch.merge_sketches(made(reference, "reference-days")), "reference-sketch")
    scores = drift_sketch.sketch_drift(merged, made(current, "days")).withColumnRenamed("drift_score", "about")
    exact = drift.numeric_drift(_value_counts(spark, folder))
    return exact.join(scores, ["day", "column_name"], "full_outer").select(
        "day", "column_name", F.coalesce(F.abs(F.col("about") - F.col("drift_score")) <= NEAR, F.lit(False)).alias("is_near")
    )


def drift_categorical(spark, folder):
    counts = _value_counts(spark, folder)
    return rounded(drift.categorical_drift(counts), "drift_score")


def column_drift(spark, folder):
    return rounded(drift.column_drift(*_drift_sides(spark, folder)), "drift_score")


def drift_summary(spark, folder):
    summary = drift.drift_summary(drift.column_drift(*_drift_sides(spark, folder)))
    return rounded(summary, "share_of_drifted_columns")


def _performance(spark, folder):
    scored = drift.with_day(feature_rows(spark, folder)).withColumn("prediction", F.col("stock"))
    return drift.daily_performance(scored, TARGET, "prediction")


def daily_performance(spark, folder):
    return rounded(_performance(spark, folder), "rmse", "mae", "abs_error_max")


def _old_and_new_performance(spark, folder):
    table = _performance(spark, folder)
    moved = table.select("timestamp", *[(F.col(c) + 1).alias(c) for c in table.columns[1:]])
    old = moved.where(F.col("timestamp") < F.lit("2024-01-21").cast("timestamp_ntz"))
    new = table.where(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return old, new


def _months(table):
    """The months that a table has rows of."""
    return [r["m"] for r in table.select(F.trunc("day", "month").alias("m")).distinct().collect()]


def _backfilled(spark, folder, name):
    root = shared_path(spark, "backfill")
    reference, current = _drift_sides(spark, folder)
    current = materialize(feature_rows(spark, folder).join(current.select("day").distinct(), F.to_date("time") == F.col("day"), "left_semi"), "current")
    for month in _months(drift.with_day(current)):
        for _ in range(2):  # days already reported stay as they are
            monitoring.backfill_drift(spark, root, reference.drop("day"), current, month)
    return tables.ensure_metric_tables(spark, root)[name].read()


def backfill_column_drift(spark, folder):
    return rounded(_backfilled(spark, folder, "column_drift"), "drift_score")


def backfill_drift_summary(spark, folder):
    return rounded(_backfilled(spark, folder, "dataset_summary"), "share_of_drifted_columns")


def backfill_performance(spark, folder):
    """The champion's error by day, for all months."""
    table = materialize(_stump_rows(spark, folder), "features")
    root = shared_path(spark, "backfill")
    model = training.load_champion(spark, _trained(spark, folder))
    for month in _months(drift.with_day(table)):
        monitoring.backfill_performance(spark, root, model, table, month)
    read = tables.ensure_metric_tables(spark, root)["model_performance"].read()
    return rounded(read, "rmse", "mae", "abs_error_max")


def upsert_keep_first(spark, folder):
    merged = upsert.upsert_keep_first(*_old_and_new_performance(spark, folder), ["timestamp"])
    return rounded(merged, "rmse", "mae", "abs_error_max")


def upsert_partial(spark, folder):
    old, new = _old_and_new_performance(spark, folder)
    merged = upsert.upsert_partial(old, new, ["timestamp"], ["rmse"])
    return rounded(merged, "rmse", "mae", "abs_error_max")


def _old_and_new_orders(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    orders = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    new = orders.withColumns({"o_orderstatus": F.lit("N"), "o_totalprice": F.col("o_totalprice") + 1})
    return orders.where(F.col("o_orderstatus") == "F"), new


def upsert_orders_keep_first(spark, folder):
    merged = upsert.upsert_keep_first(*_old_and_new_orders(spark, folder), ["o_orderkey"])
    return rounded(merged, "o_totalprice")


def upsert_orders_partial(spark, folder):
    old, new = _old_and_new_orders(spark, folder)
    merged = upsert.upsert_partial(old, new, ["o_orderkey"], ["o_orderstatus"])
    return rounded(merged, "o_totalprice")


def keyed_orders(spark, folder):
    """The same merge on a stored table in buckets: the new orders come in three parts, by date."""
    old, new = _old_and_new_orders(spark, folder)
    path, keys = shared_path(spark, "orders"), ["o_orderkey"]
    table = KeyedTable(spark, path, old.schema, keys, buckets=16)
    table.create_if_absent()
    table.merge(old, partial(upsert.upsert_keep_first, keys=keys))
    refresh = partial(upsert.upsert_partial, keys=keys, update_columns=["o_orderstatus"])
    for part in range(3):
        table.merge(new.where(F.pmod(F.year("o_orderdate"), F.lit(3)) == part), refresh)
    return rounded(table.read(), "o_totalprice")


def dash_drift(spark, folder):
    sides = _drift_sides(spark, folder)
    return rounded(drift.drift_over_time(drift.column_drift(*sides), "stock"), "drift_score")


def dash_performance(spark, folder):
    return rounded(drift.performance_over_time(_performance(spark, folder)), "rmse", "mae")


def day_series(spark, folder):
    return drift.day_series(stock_all(spark, folder), "2024-01-04", "view")


# --- streams ----------------------------------------------------------------------------


STREAM_FILES = 20


def _arriving_trips(spark, folder):
    """Trips in the order of their starts, each file a batch of its own."""

    def build():
        return trips(spark, folder).repartitionByRange(STREAM_FILES, "started_at", "ride_id")

    return clean.preprocess(_stream(spark, folder, "trips-by-start", build))


def stream_net_flow(spark, folder):
    path = shared_path(spark, "stream-net-flow")
    flows = stations.station_flows(_arriving_trips(spark, folder), top_n=None)
    net_flow_stream.start_net_flow(flows, path, f"{path}-progress").awaitTermination()
    return net_flow_stream.read_net_flow(spark, path)


def stream_daily_stock(spark, folder):
    arriving = _arriving_trips(spark, folder)
    path = shared_path(spark, "stream-stock")
    query = daily_stock.start_daily_stock(
        stations.station_flows(arriving, top_n=None), path, f"{path}/progress"
    )
    query.awaitTermination()
    return daily_stock.read_daily_stock(spark, path)


def stream_alerts(spark, folder):
    def build():
        return stock(spark, folder).repartitionByRange(STREAM_FILES, "time", "station", "rideable_type")

    arriving = _stream(spark, folder, "stock-by-time", build).withColumnRenamed("stock", "prediction")
    path = shared_path(spark, "stream-alerts")
    alert_stream.start_alerts(arriving, path, f"{path}/progress").awaitTermination()
    return alert_stream.read_alerts(spark, path)


def stream_closed_slots(spark, folder):
    """Slots that the stream has closed, those still open, and late flows, added up."""
    flows = stations.station_flows(_arriving_trips(spark, folder), top_n=None)
    path = shared_path(spark, "stream-closing")
    closing.start_closing(flows, path, f"{path}-progress").awaitTermination()
    return closing.read_all(spark, path)


def stateful_daily_stock(spark, folder):
    """The same by Spark's own state, a state a series and day."""
    flows = stations.station_flows(_arriving_trips(spark, folder), top_n=None)
    path = shared_path(spark, "stateful-stock")
    stateful.start_stock(flows, path, f"{path}-progress").awaitTermination()
    return stateful.read_stock(spark, path)


def stateful_alerts(spark, folder):
    def build():
        return stock(spark, folder).repartitionByRange(STREAM_FILES, "time", "station", "rideable_type")

    arriving = _stream(spark, folder, "stock-by-time", build).withColumnRenamed("stock", "prediction")
    path = shared_path(spark, "stateful-alerts")
    stateful.start_alerts(arriving, path, f"{path}-progress").awaitTermination()
    return stateful.read_alerts(spark, path)


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_trips, append_trips, refresh_trips, publish_models, stored_stock, stored_features,
        publish_next_year, published_stations, published_staging, validate_months, var_total,
        var_total_forecast, wide_csv, metric_table, stg_trips, parse_ts, drop_nulls, drop_nulls_subset, duration_stats,
        duration_outliers, starts_by_station, ends_by_station, top_stations_both,
        top_stations_starts, top_station_trips, station_flows, net_flow_all_stations,
        grid_bounds, time_grid, dense_net_flow, stock_series, stock_all_stations, stock_wide,
        wide_to_long, calendar_features, calendar_features_scoring, lag_features, time_split,
        stock_diff, one_hot, minmax_scale, minmax_restore, sequences, feature_corr,
        unique_check, type_counts, hist_start_time, hist_end_time, hist_duration, null_counts,
        rows_with_nulls, mixed_types, profile_lines, hist_line_prices, corr_lines, naive_rmse,
        naive_rmse_by_series, best_run, seasonal_decompose, var_fit, var_forecast,
        var_rmse_by_series, gbt_fit_score, gbt_importance, validate_requests, parse_requests,
        zip_trips, naive_metrics, gbt_stump, gbt_stump_importance, champion_scores, run_log, gbt_deep,
        search_models, backfill_column_drift, backfill_drift_summary, backfill_performance,
        score_slice, score_error, stockout_alerts, daily_features, month_days, drift_numeric,
        drift_categorical, column_drift, drift_summary, daily_performance, upsert_keep_first,
        upsert_partial, upsert_orders_keep_first, upsert_orders_partial, dash_drift,
        var_groups_fit, var_groups_forecast, boosted_stump, boosted_depth2, boosted_fit_score, boosted_importance,
        dash_performance, day_series, stream_net_flow, stream_daily_stock, stream_alerts,
        stateful_daily_stock, stateful_alerts, stream_closed_slots, daily_corr, checked_trips, keyed_orders,
        drift_sketches, grown_models,
    )
} | {
    "preprocess": complete,
    "remove_outlier": kept,
    "net_flow": net,
    "features": build_features,
    "profile": trip_profile,
}


def _comparable(name: str, query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    casts = dict.fromkeys(DATES.get(name, ()), "string")
    casts |= dict.fromkeys(MAY_BE_MISSING.get(name, ()), "double")

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = query(spark, folder)
        return df.select(*[F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`") for c in df.columns])

    return run if casts else query


QUERIES = {name: _comparable(name, query) for name, query in ALL.items()}
