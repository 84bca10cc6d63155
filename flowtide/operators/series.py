"""Flows to net flow per slot, to a gap-free grid, to stock with a daily reset."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.constants import INITIAL_STOCK, SERIES, SKIP_DAYS, SLOT_MINUTES
from flowtide.functions.calendar import ceil_day, floor_day, minutes, slot


def net_flow(flows: DataFrame, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """Sum of the flows per slot, station and type.

    The sums are combined before the shuffle, so a station with a third of all
    trips sends no more rows than a quiet one.
    """
    slots = flows.select(slot("time", slot_minutes).alias("time"), *SERIES, "flow")
    return slots.groupBy("time", *SERIES).agg(F.sum("flow").alias("net_flow"))


def grid_bounds(net: DataFrame) -> DataFrame:
    """One row: first midnight of the grid and the midnight it ends before.

    When the last slot is a midnight itself, the grid ends there and that slot is
    not part of it.
    """
    # min and max over whole rows: the subquery then needs the same columns as the
    # series itself and Spark can reuse its shuffle
    span = net.agg(
        F.min(F.struct("time", "net_flow")).alias("first"),
        F.max(F.struct("time", "net_flow")).alias("last"),
    )
    return span.select(
        floor_day(F.col("first.time")).alias("grid_start"),
        ceil_day(F.col("last.time")).alias("grid_end"),
    )


def _slots(start, end, slot_minutes: int):
    """Array of slot starts in [start, end), NULL when there is none."""
    step = minutes(slot_minutes)
    return F.when(start < end, F.sequence(start, end - step, step))


def time_grid(net: DataFrame, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """All slots of the grid, busy or not."""
    bounds = grid_bounds(net)
    days = bounds.where("grid_start < grid_end").select(
        F.explode(
            F.sequence(
                F.col("grid_start"),
                F.col("grid_end") - F.expr("INTERVAL 1 DAY"),
                F.expr("INTERVAL 1 DAY"),
            )
        ).alias("day")
    )
    return days.select(
        F.explode(_slots(F.col("day"), F.col("day") + F.expr("INTERVAL 1 DAY"), slot_minutes)).alias(
            "time"
        )
    )


def _filled(net: DataFrame, value, slot_minutes: int, skip_days: int) -> DataFrame:
    """One row per slot for every observed series, with no join against a grid.

    Each busy slot spans the slots up to the next busy one. ``value`` gets the
    slot, the busy slot it belongs to, and the running flow of that day.
    """
    bounds = grid_bounds(net).select(F.struct("grid_start", "grid_end").alias("b")).scalar()
    # one shuffle serves every window below and the lag windows after it: they are
    # all clustered by series
    busy = net.repartition(*SERIES).select(
        *SERIES,
        F.col("time").alias("busy"),
        "net_flow",
        floor_day("time").alias("day"),
        bounds.alias("grid"),
    )
    along = W.partitionBy(*SERIES).orderBy("busy")
    in_day = W.partitionBy(*SERIES, "day").orderBy("busy")
    first = F.col("grid.grid_start") + F.make_dt_interval(days=F.lit(skip_days))
    spans = busy.select(
        *SERIES,
        "busy",
        "day",
        "net_flow",
        F.sum("net_flow").over(in_day.rowsBetween(W.unboundedPreceding, 0)).alias("moved"),
        F.when(F.lag(F.lit(1)).over(along).isNull(), first)
        .otherwise(F.greatest("busy", first))
        .alias("from"),
        F.least(F.coalesce(F.lead("busy").over(along), "grid.grid_end"), "grid.grid_end").alias("to"),
    )
    slots = spans.select("*", F.explode(_slots(F.col("from"), F.col("to"), slot_minutes)).alias("time"))
    return slots.select("time", *SERIES, value)


def dense_net_flow(net: DataFrame, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """Net flow with a zero for every slot of the grid in which a series is idle."""
    value = F.when(F.col("time") == F.col("busy"), F.col("net_flow")).otherwise(F.lit(0))
    return _filled(net, value.alias("net_flow"), slot_minutes, skip_days=0)


def stock_from_net_flow(
    net: DataFrame,
    initial_stock: int = INITIAL_STOCK,
    slot_minutes: int = SLOT_MINUTES,
    skip_days: int = SKIP_DAYS,
) -> DataFrame:
    """Running stock per series on the full grid, set anew at every midnight.

    A slot counts its own flow. The first ``skip_days`` days of the grid are cut.
    Stock may become negative.
    """
    moved = (F.col("time") >= F.col("busy")) & (floor_day("time") == F.col("day"))
    stock = F.lit(initial_stock) + F.when(moved, F.col("moved")).otherwise(F.lit(0))
    return _filled(net, stock.cast("bigint").alias("stock"), slot_minutes, skip_days)
