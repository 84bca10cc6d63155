import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flowtide.schemas import TRIP
from flowtide.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4)
    yield session
    session.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def trip(ride_id, start, end, started_at, ended_at, kind="classic_bike", **other):
    values = {
        "ride_id": ride_id,
        "rideable_type": kind,
        "started_at": ts(started_at),
        "ended_at": ts(ended_at),
        "start_station_name": start,
        "start_station_id": "1",
        "end_station_name": end,
        "end_station_id": "2",
        "start_lat": 40.1,
        "start_lng": -73.1,
        "end_lat": 40.2,
        "end_lng": -73.2,
        "member_casual": "member",
    } | other
    return tuple(values[f.name] for f in TRIP)


@pytest.fixture(scope="session")
def three_trips(spark):
    """One day, three trips."""
    rows = [
        trip("p7", "Mill", "Pier", "2024-05-14 22:41:00", "2024-05-14 22:48:00", "electric_bike"),
        trip("k2", "Pier", "Mill", "2024-05-14 06:12:30", "2024-05-14 06:25:00"),
        trip("w5", "Pier", "Mill", "2024-05-14 13:05:15", "2024-05-14 13:36:15"),
    ]
    return spark.createDataFrame(rows, TRIP)


@pytest.fixture(scope="session")
def midnight_trips(spark):
    """Three days; the last flow falls on a midnight exactly."""
    rows = [
        trip("A", "St1", "St2", "2024-01-01 08:00:00", "2024-01-01 08:10:00"),
        trip("B", "St1", "St2", "2024-01-02 08:05:00", "2024-01-02 08:20:00"),
        trip("C", "St2", "St1", "2024-01-02 23:50:00", "2024-01-03 00:05:00"),
    ]
    return spark.createDataFrame(rows, TRIP)
