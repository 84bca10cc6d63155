"""Buckets: what a merge rewrites, and what two writers at once leave."""

from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.operators.upsert import upsert_keep_first, upsert_partial
from flowtide.session import delete_path, read_text, shared_path, write_new
from flowtide.sources.keyed_table import KeyedTable

SCHEMA = T.StructType(
    [T.StructField("day", T.DateType()), T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())]
)
KEYS = ["day", "name"]
keep = partial(upsert_keep_first, keys=KEYS)
refresh = partial(upsert_partial, keys=KEYS, update_columns=["score"])


def days(spark, first, last, score=0.0):
    dates = spark.range(first, last).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    return dates.select("day", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("name"), F.lit(float(score)).alias("score"))


@pytest.fixture
def table(spark):
    made = KeyedTable(spark, shared_path(spark, "keyed"), SCHEMA, KEYS, buckets=16, bucket_by=["day"])
    made.create_if_absent()
    return made


def contents(df):
    return sorted((str(r["day"]), r["name"], r["score"]) for r in df.collect())


def test_one_day_rewrites_one_bucket(spark, table):
    table.merge(days(spark, 0, 60), keep)
    before = table.snapshot()[1]
    assert len(before) > 8
    version = table.merge(days(spark, 7, 8, 1.0), refresh)
    after = table.snapshot(version)[1]
    assert [b for b in after if after[b] != before.get(b)] and len([b for b in after if after[b] != before.get(b)]) == 1
    expected = {(str(r["day"]), r["name"]): 0.0 for r in days(spark, 0, 60).collect()} | {
        ("2024-01-08", n): 1.0 for n in "ab"
    }
    assert contents(table.read()) == sorted((*k, v) for k, v in expected.items())
    # the version before is still whole
    assert all(score == 0.0 for _, _, score in contents(table.read(version - 1)))


def test_merges_equal_one_merge_of_all(spark, table):
    whole = upsert_keep_first(spark.createDataFrame([], SCHEMA), days(spark, 0, 30), KEYS)
    for first in range(0, 30, 10):
        table.merge(days(spark, max(first - 3, 0), first + 10, 0.0), keep)
    assert contents(table.read()) == contents(whole)


@pytest.mark.parametrize("other_day", [7, 8])
def test_two_writers_lose_nothing(spark, table, other_day):
    """The second writer commits while the first is in its merge, in the same bucket or not."""
    table.merge(days(spark, 0, 20), keep)
    calls = []

    def slow(existing, new):
        if not calls:
            second = KeyedTable(spark, table.path, SCHEMA, KEYS, buckets=16, bucket_by=["day"])
            extra = days(spark, other_day, other_day + 1, 5.0).withColumn("name", F.concat("name", F.lit("2")))
            second.merge(extra, keep)
        calls.append(1)
        return refresh(existing, new)

    version = table.merge(days(spark, 7, 8, 1.0), slow)
    assert version == 3
    found = {(d, n): s for d, n, s in contents(table.read())}
    assert found["2024-01-08", "a"] == 1.0 and found[f"2024-01-{other_day + 1:02d}", "a2"] == 5.0
    assert len(found) == 42
    # another bucket needs no second merge
    assert len(calls) == (2 if other_day == 7 else 1)


def test_the_commit_is_refused_where_the_name_is_taken(spark, table):
    path = shared_path(spark, "once")
    assert write_new(spark, path, "first") and not write_new(spark, path, "second")
    assert read_text(spark, path) == "first"
    assert not table._commit(0, {"1": "nowhere"}) and table.snapshot() == (0, {})


def test_expired_versions_take_their_folders(spark, table):
    for score in range(6):
        table.merge(days(spark, 0, 4, score), refresh)
    held = contents(table.read())
    assert table.expire(keep=2) > 0
    assert table.versions() == [5, 6] and contents(table.read()) == held
    assert table.expire(keep=2) == 0


def test_torn_merges_empty_rows_and_nulls(spark, table):
    assert table.merge(days(spark, 0, 0), keep) == 0 and table.read().count() == 0
    days(spark, 0, 3).write.parquet(f"{table.path}/data/torn")
    assert table.read().count() == 0
    wider = days(spark, 0, 3).withColumns({"_bucket": F.lit("x"), "more": F.lit(1)})
    table.merge(wider, keep)
    assert table.read().columns == SCHEMA.names and table.read().count() == 6
    with pytest.raises(Exception, match="NULL in day"):
        table.merge(days(spark, 0, 1).withColumn("day", F.lit(None).cast("date")), keep)
    with pytest.raises(Exception, match="left the buckets"):
        table.merge(days(spark, 0, 1), lambda old, new: new.withColumn("day", F.date_add("day", 1)))
    assert table.read().count() == 6
    # rows that a merge takes away
    table.merge(days(spark, 0, 3), lambda old, new: old.limit(0))
    assert table.read().count() == 0
    with pytest.raises(ValueError, match="buckets"):
        KeyedTable(spark, table.path, SCHEMA, KEYS, buckets=8).read()
    delete_path(spark, table.path)
    assert table.read().count() == 0
