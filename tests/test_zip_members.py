"""Members of archives against the lines that were put in."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from flowtide.schemas import TRIP, TRIP_TEXT
from flowtide.session import shared_path
from flowtide.sources import trip_files, zip_members

HEADER = ",".join(TRIP_TEXT.names)


def line(key):
    return f"{key},classic_bike,2024-05-01 08:00:00,2024-05-01 08:10:00,A,1,B,2,40.1,-73.1,40.2,-73.2,member"


def archive(folder, name, members):
    os.makedirs(folder, exist_ok=True)
    beside = f"{folder}/.{name}"
    with zipfile.ZipFile(beside, "w", zipfile.ZIP_DEFLATED) as out:
        for member, text in members.items():
            out.writestr(member, text)
    os.rename(beside, f"{folder}/{name}")


def members(label, count, rows):
    return {
        f"{label}-{m}.csv": "\n".join([HEADER, *[line(f"{label}-{m}-{i}") for i in range(rows)]]) + "\n"
        for m in range(count)
    }


def test_one_archive_of_eight_members_uses_eight_tasks(spark):
    folder = shared_path(spark, "eight")
    archive(folder, "a.zip", members("a", 8, 30))
    read = zip_members.read_zip_members(spark, folder, tasks=8)
    tasks = read.select(F.spark_partition_id().alias("task"), F.regexp_extract("ride_id", r"a-(\d)", 1).alias("member"))
    pairs = {(r["task"], r["member"]) for r in tasks.distinct().collect()}
    assert len(pairs) == len({t for t, _ in pairs}) == 8
    assert read.count() == 240 and read.schema == TRIP
    # the archives' contents are not in the scan, only their names
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("FileScan", 1)[-1].split("ReadSchema", 1)[-1]


def test_equal_to_whole_archives(spark):
    folder = shared_path(spark, "several")
    for k in range(3):
        archive(folder, f"{k}.zip", members(f"m{k}", k + 1, 5) | {"__MACOSX/x.csv": "rubbish", "notes.txt": "no trips"})
    by_member, whole = zip_members.read_zip_members(spark, folder), trip_files.read_trip_zips(spark, folder)
    rows = sorted(map(repr, by_member.collect()))
    assert rows == sorted(map(repr, whole.collect())) and len(rows) == 30


def test_odd_archives(spark):
    folder = shared_path(spark, "odd")
    archive(folder, "none.zip", {})
    archive(folder, "empty.zip", {"empty.csv": "", "header.csv": HEADER + "\n"})
    archive(folder, "other.zip", {"other.csv": ",".join(["more", *reversed(TRIP_TEXT.names)]) + "\nx" + "," * 13 + "s\n"})
    (row,) = zip_members.read_zip_members(spark, folder).collect()
    assert row.ride_id == "s" and row.started_at is None and row.end_lng is None
    listed = zip_members.zip_members(spark.read.format("binaryFile").load(f"{folder}/empty.zip")).collect()
    assert sorted((r["member"], r["size"]) for r in listed) == [("empty.csv", 0), ("header.csv", len(HEADER) + 1)]
    with open(f"{folder}/torn.zip", "w") as out:
        out.write("no archive")
    with pytest.raises(Exception, match="zip"):
        zip_members.read_zip_members(spark, folder).collect()
    archive(f"{folder}-short", "short.zip", {"short.csv": "ride_id\ns\n"})
    with pytest.raises(Exception, match="not"):
        zip_members.read_zip_members(spark, f"{folder}-short").collect()


def test_stream_of_archives_reads_each_once_after_a_restart(spark):
    folder = shared_path(spark, "arriving-zips")
    out, progress = f"{folder}-out", f"{folder}-progress"

    def run():
        arriving = zip_members.stream_zip_members(spark, folder, tasks=4, archives_per_batch=1)
        query = arriving.writeStream.format("parquet").option("checkpointLocation", progress)
        query.trigger(availableNow=True).start(out).awaitTermination()
        return sorted(r["ride_id"] for r in spark.read.schema(TRIP).parquet(out).select("ride_id").collect())

    archive(folder, "a.zip", members("a", 2, 4))
    archive(folder, "b.zip", members("b", 3, 4))
    assert len(run()) == 20
    archive(folder, "c.zip", members("c", 1, 4))
    found = run()
    assert len(found) == len(set(found)) == 24 and run() == found
