"""The table models: staging, busiest stations, marts; and the feature pipeline."""

from pyspark.sql import DataFrame, SparkSession

from flowtide.constants import INITIAL_STOCK, LAGS, SKIP_DAYS, SLOT_MINUTES, TOP_STATIONS
from flowtide.operators import clean, features, series, stations


def stock_series(
    trips: DataFrame,
    stations_: DataFrame | None = None,
    top_n: int | None = TOP_STATIONS,
    slot_minutes: int = SLOT_MINUTES,
    initial_stock: int = INITIAL_STOCK,
    skip_days: int = SKIP_DAYS,
) -> DataFrame:
    """Cleaned trips to stock per slot, station and type (long form)."""
    flows = stations.station_flows(trips, stations_, top_n)
    net = series.net_flow(flows, slot_minutes)
    return series.stock_from_net_flow(net, initial_stock, slot_minutes, skip_days)


def build_stock(trips: DataFrame, **options) -> DataFrame:
    """Raw trips to stock: clean, cut outliers, then :func:`stock_series`."""
    return stock_series(clean.remove_outlier(clean.preprocess(trips)), **options)


def build_features(
    trips: DataFrame, lags: int = LAGS, keep_time: bool = False, **options
) -> DataFrame:
    """Raw trips to the feature table. One lazy plan from scan to features."""
    slot_minutes = options.get("slot_minutes", SLOT_MINUTES)
    return features.features(
        build_stock(trips, **options), lags, keep_time=keep_time, slot_minutes=slot_minutes
    )


def publish_models(
    spark: SparkSession, raw: dict[int, DataFrame], station_year: int, tables: str
) -> dict[str, DataFrame]:
    """Staging views, the busiest stations and the filtered trips as tables.

    ``raw`` maps a year to its raw trips. The stations of ``station_year`` select
    the trips of every year. ``tables`` is the folder the marts are written to.
    """
    published = {}
    for year, trips in raw.items():
        staged = clean.stage_trips(trips)
        staged.createOrReplaceTempView(f"stg_trips_{year}")
        published[f"stg_trips_{year}"] = staged
    top = stations.top_stations_by_both(published[f"stg_trips_{station_year}"])
    top.createOrReplaceTempView("int_top_stations")
    published["int_top_stations"] = top
    for year in raw:
        name = f"fct_{year}_top_trips"
        mart = stations.trips_touching(published[f"stg_trips_{year}"], top)
        mart.write.mode("overwrite").parquet(f"{tables}/{name}")
        published[name] = spark.read.schema(mart.schema).parquet(f"{tables}/{name}")
        published[name].createOrReplaceTempView(name)
    return published
