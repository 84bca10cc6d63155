"""Models in order, and what a rerun reads."""

import pytest
from pyspark.sql import functions as F

from flowtide.plans.named_models import Model, build_order, read_model, run_models
from flowtide.session import shared_path


def rides(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").alias("at"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), (F.col("id") % 3).cast("string"))).alias("station")
    )


def models(seen):
    def staged(source):
        return source.where("station IS NOT NULL")

    def kept(source):
        seen.append(sorted(r["at"] for r in source.collect()))
        return source.withColumn("twice", F.col("at") * 2)

    def busiest(rows):
        return rows.groupBy("station").agg(F.count("*").alias("n"))

    return [
        Model("mart_busiest", ["fct_rides", "names"], lambda rows, names: busiest(rows).join(names, "station", "left"), "table"),
        Model("fct_rides", ["stg_rides"], kept, "growing", "at"),
        Model("stg_rides", ["rides"], staged),
    ]


def test_order_and_refusals():
    assert build_order(models([]), ["rides", "names"]) == ["stg_rides", "fct_rides", "mart_busiest"]
    same = lambda df: df
    with pytest.raises(Exception, match="cycle"):
        build_order([Model("a", ["b"], same), Model("b", ["a"], same)])
    with pytest.raises(ValueError, match="unknown: .'c'"):
        build_order([Model("a", ["c"], same)])
    with pytest.raises(ValueError, match="twice: .'a'"):
        build_order([Model("a", [], same), Model("a", [], same)])
    with pytest.raises(ValueError, match="mark"):
        Model("a", [], same, "growing")


def test_a_rerun_reads_only_new_rows(spark):
    root, seen = shared_path(spark, "models"), []
    names = spark.createDataFrame([("s1", "Mill")], "station string, label string")
    run = lambda last: run_models(spark, models(seen), {"rides": rides(spark, 0, last), "names": names}, root)
    assert list(run(10)) == ["stg_rides", "fct_rides", "mart_busiest"]
    built = run(16)
    assert seen == [[1, 2, 4, 5, 7, 8], [10, 11, 13, 14]]
    assert sorted(r["at"] for r in built["fct_rides"].collect()) == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]
    assert {(r["station"], r["n"], r["label"]) for r in built["mart_busiest"].collect()} == {("s1", 5, "Mill"), ("s2", 5, None)}
    # nothing new: not built again, and the same from SQL and from storage
    run(16)
    assert len(seen) == 2
    assert spark.sql("SELECT count(*) FROM fct_rides").first()[0] == read_model(spark, root, "fct_rides").count() == 10


def test_only_some_and_what_they_read(spark):
    root, seen = shared_path(spark, "models"), []
    sources = {"rides": rides(spark, 0, 5), "names": rides(spark, 0, 0)}
    assert list(run_models(spark, models(seen), sources, root, only=["fct_rides"])) == ["stg_rides", "fct_rides"]
    with pytest.raises(ValueError, match="not been run"):
        read_model(spark, root, "mart_busiest")


def test_empty_sources_torn_runs_and_changed_columns(spark):
    root, seen = shared_path(spark, "models"), []
    fct = Model("fct", ["rides"], lambda df: df, "growing", "at")
    assert run_models(spark, [fct], {"rides": rides(spark, 0, 0)}, root)["fct"].count() == 0
    # a run that failed after writing: its part is written over
    rides(spark, 0, 99).write.parquet(f"{root}/fct/part-000001")
    assert read_model(spark, root, "fct").count() == 0
    assert run_models(spark, [fct], {"rides": rides(spark, 0, 4)}, root)["fct"].count() == 4
    with pytest.raises(ValueError, match="other columns"):
        run_models(spark, [Model("fct", ["rides"], lambda df: df.drop("station"), "growing", "at")], {"rides": rides(spark, 0, 9)}, root)
    assert read_model(spark, root, "fct").count() == 4
    # a table is whole at each run, and two of its runs stay
    mart = Model("mart", ["rides"], lambda df: df, "table")
    for last in (3, 5, 2):
        assert run_models(spark, [mart], {"rides": rides(spark, 0, last)}, root)["mart"].count() == last
