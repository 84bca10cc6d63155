"""Keyed merges of a table with new rows. Both return the merged table.

Repeated keys among the new rows need an ``order``: a column that says which came
first. Without it they fail the query, since no row of them is the right one.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first_and_last(new: DataFrame, keys: Sequence[str], rest: Sequence[str], order: str | None) -> DataFrame:
    """Per key the first and the last row, combined before the shuffle."""
    row = F.struct(F.lit(True).alias("_here"), *rest)
    if order is not None:
        return new.groupBy(*keys).agg(F.min_by(row, order).alias("first"), F.max_by(row, order).alias("last"))
    repeated = F.raise_error(F.lit("repeated keys among the new rows, and no order"))
    once = F.when(F.count(F.lit(1)) == 1, F.min(row)).otherwise(repeated)
    return new.groupBy(*keys).agg(once.alias("first")).withColumn("last", F.col("first"))


def upsert_keep_first(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None
) -> DataFrame:
    """Add the new rows whose key does not exist yet; existing rows stay as they are.

    Of new rows with one key the first by ``order`` counts.
    """
    rest = [c for c in existing.columns if c not in keys]
    added = _first_and_last(new, keys, rest, order).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(added.select(*keys, "first.*").select(*existing.columns))


def upsert_partial(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    order: str | None = None,
) -> DataFrame:
    """Add new keys; for known keys refresh ``update_columns`` only.

    Of new rows with one key the last by ``order`` gives the refreshed columns, and
    the first all others.
    """
    rest = [c for c in existing.columns if c not in keys]
    old = existing.select(*keys, F.struct(F.lit(True).alias("_here"), *rest).alias("old"))
    merged = old.join(_first_and_last(new, keys, rest, order), list(keys), "full_outer")
    known, refreshed = F.col("old").isNotNull(), F.col("last").isNotNull()
    values = {
        c: F.when(refreshed, F.col("last")[c]).otherwise(F.col("old")[c])
        if c in update_columns
        else F.when(known, F.col("old")[c]).otherwise(F.col("first")[c])
        for c in rest
    }
    return merged.select(*[values.get(c, F.col(c)).alias(c) for c in existing.columns])
