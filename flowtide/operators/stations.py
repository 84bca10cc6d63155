"""Station counts, the busiest stations, and filters by them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.constants import TOP_STATIONS


def starts_by_station(trips: DataFrame) -> DataFrame:
    return _count_by(trips, "start_station_name")


def ends_by_station(trips: DataFrame) -> DataFrame:
    return _count_by(trips, "end_station_name")


def _count_by(trips: DataFrame, column: str) -> DataFrame:
    counts = trips.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n_trips")).orderBy(F.desc("n_trips"), column)


def top_stations_by_starts(trips: DataFrame, n: int = TOP_STATIONS) -> DataFrame:
    """The ``n`` stations most trips start from; ties go by name."""
    counts = _count_by(trips, "start_station_name").limit(n)
    return counts.select(F.col("start_station_name").alias("station"), "n_trips")


def top_stations_by_both(trips: DataFrame, n: int = TOP_STATIONS) -> DataFrame:
    """The ``n`` stations with most starts plus ends; ties go by name."""
    # one pass over the trips instead of one per end
    ends = trips.select(
        F.explode(F.array("start_station_name", "end_station_name")).alias("station")
    )
    counts = ends.where(F.col("station").isNotNull()).groupBy("station")
    return (
        counts.agg(F.count(F.lit(1)).alias("n_trips")).orderBy(F.desc("n_trips"), "station").limit(n)
    )


def trips_touching(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Trips that start or end at one of ``stations``; the other end may be NULL.

    ``stations`` is an input, so one year's stations can select another's trips.
    """
    names = stations.select("station")
    return trips.where(
        F.col("start_station_name").isin(names) | F.col("end_station_name").isin(names)
    )


def station_flows(
    trips: DataFrame,
    stations: DataFrame | Sequence[str] | None = None,
    top_n: int | None = TOP_STATIONS,
) -> DataFrame:
    """Each trip as -1 at its start and +1 at its end: time, station, type, flow.

    Only ``stations`` are kept; left out, these are the ``top_n`` stations by
    starts, or all stations when ``top_n`` is None.
    """
    if stations is None and top_n is not None:
        stations = top_stations_by_starts(trips, top_n)
    ends = F.array(
        F.struct(
            F.col("started_at").alias("time"),
            F.col("start_station_name").alias("station"),
            F.lit(-1).alias("flow"),
        ),
        F.struct(
            F.col("ended_at").alias("time"),
            F.col("end_station_name").alias("station"),
            F.lit(1).alias("flow"),
        ),
    )
    flows = trips.select(F.explode(ends).alias("e"), "rideable_type").select(
        "e.time", "e.station", "rideable_type", "e.flow"
    )
    if stations is None:
        return flows
    if isinstance(stations, DataFrame):
        return flows.join(stations.select("station"), "station", "left_semi").select(
            "time", "station", "rideable_type", "flow"
        )
    return flows.where(F.col("station").isin(list(stations)))
