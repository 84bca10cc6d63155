"""Long series to one column per series, and back."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"


def series_names(stock: DataFrame) -> list[str]:
    """Sorted station|type names of the observed series, which are to become columns."""
    name = F.concat_ws(SEPARATOR, "station", "rideable_type").alias("name")
    rows = stock.select(name).distinct().collect()
    return sorted(row.name for row in rows)


def long_to_wide(
    stock: DataFrame, names: Sequence[str] | None = None, value: str = "stock"
) -> DataFrame:
    """One row per slot, one column per series named station|type, 0 where absent.

    Known ``names`` save the pass that looks them up. A series that is not among them
    fails the query: it would have no column to go to.
    """
    names = list(names) if names is not None else series_names(stock)
    keyed = stock.select(
        "time", F.concat_ws(SEPARATOR, "station", "rideable_type").alias("name"), value
    )
    name = F.col("name")
    listed = F.when(name.isin(names), name).otherwise(
        F.raise_error(F.concat(F.lit("series without a column: "), name))
    )
    wide = keyed.withColumn("name", listed).groupBy("time").pivot("name", names).agg(F.sum(value))
    return wide.na.fill(0)


def wide_to_long(wide: DataFrame, value: str = "stock") -> DataFrame:
    """Inverse of :func:`long_to_wide`."""
    names = [c for c in wide.columns if c != "time"]
    long = wide.unpivot("time", [F.col(f"`{n}`") for n in names], "name", value)
    # the type holds no separator, so the last one splits the name
    return long.select(
        "time",
        F.regexp_extract("name", r"^(.*)\|([^|]*)$", 1).alias("station"),
        F.regexp_extract("name", r"^(.*)\|([^|]*)$", 2).alias("rideable_type"),
        value,
    )
