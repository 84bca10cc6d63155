"""Connected components of a graph that no single task or driver holds.

Alternating large-star and small-star steps: each joins the edges with one minimum
per node, so a node with a third of all edges is a group of narrow rows that is
pre-aggregated before its shuffle and whose join Spark can split. The number of
rounds grows with the logarithm of the size of a component.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.session import drop_table, write_table


def _linked(pairs: DataFrame) -> DataFrame:
    """Each edge once, from the greater node to the smaller one."""
    u, v = F.col("u"), F.col("v")
    return (
        pairs.where(u.isNotNull() & v.isNotNull() & (u != v))
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where(F.col("v") > F.col("m"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node of an edge; component is its least node.

    Nulls on either side, loops and repeated edges add nothing. An empty table gives
    an empty table. Writes one narrow table a round into the shared folder, and
    drops that of the round before.
    """
    spark = edges.sparkSession
    path = write_table(
        _linked(edges.select(F.col(left).alias("u"), F.col(right).alias("v"))), "edges"
    )
    schema = None
    before = None
    while True:
        now = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
        schema = now.schema
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = seen
        after = write_table(_linked(_small_star(_linked(_large_star(now)))), "edges")
        drop_table(spark, path)
        path = after
