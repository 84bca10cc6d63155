"""Daily drift of feature columns against a reference, and daily model error.

All days of a period are computed in one job: rows are reduced to counts per
(day, column, value) first, and everything after works on those counts.
"""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.constants import (
    CATEGORICAL_FEATURES,
    COLUMN_DRIFT_THRESHOLD,
    DATASET_DRIFT_SHARE,
    NUMERICAL_FEATURES,
    TARGET,
)
from flowtide.functions.calendar import day_of_scaled_date
from flowtide.functions.statistics import mae, max_abs_error, rmse
from flowtide.operators.bucketed import running_over_buckets
from flowtide.session import materialize

# A reference column narrower than this counts as this wide.
SMALLEST_SPREAD = 0.001


def with_day(features: DataFrame) -> DataFrame:
    """Add the calendar ``day`` that the scaled ``date`` stands for."""
    return features.select("*", day_of_scaled_date("date").alias("day"))


def daily_features(features: DataFrame) -> DataFrame:
    """Rows and mean stock per day: which days a monitoring run can report on."""
    return (
        with_day(features)
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg("stock").alias("mean_stock"))
    )


def month_days(first_days: DataFrame, column: str = "month") -> DataFrame:
    """Every day of each given month, with the number of days it has."""
    start = F.trunc(F.col(column), "month")
    end = F.last_day(F.col(column))
    return first_days.select(
        start.alias("month"),
        F.day(end).alias("days_in_month"),
        F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("day"),
    )


def value_counts_by_day(
    reference: DataFrame,
    current: DataFrame,
    numerical: Sequence[str] = NUMERICAL_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> DataFrame:
    """Rows per (day, column, value); the reference rows have no day.

    One pass over either side, combined before the shuffle. ``value`` is a number
    or a ``label``, by the kind of the column.
    """
    number, label = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"), label.alias("label"))
        for c in numerical
    ] + [
        F.struct(F.lit(c).alias("column_name"), number.alias("value"), F.col(c).alias("label"))
        for c in categorical
    ]

    def cells_of(table: DataFrame, day) -> DataFrame:
        return table.select(day, F.explode(F.array(*cells)).alias("cell")).select("day", "cell.*")

    both = cells_of(reference, F.lit(None).cast("date").alias("day")).unionByName(
        cells_of(current, F.col("day"))
    )
    known = both.where(F.col("value").isNotNull() | F.col("label").isNotNull())
    return known.groupBy("day", "column_name", "value", "label").agg(F.count(F.lit(1)).alias("n"))


def _deviations(counts: DataFrame) -> DataFrame:
    """Population deviation of each reference column, never below the smallest spread."""
    reference = counts.where(F.col("day").isNull() & F.col("value").isNotNull())
    means = reference.groupBy("column_name").agg(
        F.sum("n").alias("rows"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean")
    )
    square = F.col("n") * F.pow(F.col("value") - F.col("mean"), 2)
    return (
        reference.join(means, "column_name")
        .groupBy("column_name")
        .agg(F.sqrt(F.sum(square) / F.max("rows")).alias("std"))
        .select("column_name", F.greatest("std", F.lit(SMALLEST_SPREAD)).alias("std"))
    )


def _areas(counts: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Reference and current values with the reference's share up to them and the area
    below that share: its integral up to the value, which is value * share less the sum
    of the values up to it over the number of rows.

    Both kinds of values are sorted together, once, over buckets between quantiles of
    the reference, so that a long tail is no fuller bucket than any other.
    """
    known = counts.where(F.col("value").isNotNull())
    is_reference = F.col("day").isNull()
    reference = known.where(is_reference)
    steps = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
    columns = reference.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
        F.percentile_approx("value", steps, 10_000).alias("bounds"),
    )
    placed = known.join(columns, "column_name").select(
        "day",
        "column_name",
        "value",
        "n",
        "rows",
        "mean",
        is_reference.alias("is_reference"),
        F.size(F.filter("bounds", lambda b: b < F.col("value"))).alias("bucket"),
    )
    own = F.when(F.col("is_reference"), F.col("n")).otherwise(0)
    summed = running_over_buckets(
        # at an equal value the reference comes first: the shares include it
        placed.withColumn("later", ~F.col("is_reference")),
        group=["column_name"],
        bucket="bucket",
        order=["value", "later", "day"],
        sums={"upto_n": own, "upto_sum": own * F.col("value")},
        leads={},
    )
    share = F.col("upto_n") / F.col("rows")
    area = F.col("value") * share - F.col("upto_sum") / F.col("rows")
    points = summed.withColumns({"share": share, "area": area})
    return points.where("is_reference"), points.where(~F.col("is_reference"))


def _crossings(reference: DataFrame, queries: DataFrame, buckets: int) -> DataFrame:
    """``queries`` with ``cross``: the first reference value whose share is not below
    ``upto``, and its area.

    Values grow with their shares, so it is the least one among those that follow; a
    bucket of shares finds it within, or in the nearest later bucket that has any.
    """
    bucket = F.floor(F.col("at") * buckets)
    columns = ["column_name", "at", "target", "row"]
    marks = reference.select("column_name", F.col("share").alias("at"), F.struct("value", "area").alias("target"))
    asked = queries.select("column_name", F.col("upto").alias("at"), F.struct(*queries.columns).alias("row"))
    both = marks.withColumn("row", F.lit(None).cast(asked.schema["row"].dataType)).select(*columns).unionByName(
        asked.withColumn("target", F.lit(None).cast(marks.schema["target"].dataType)).select(*columns)
    )
    both = both.withColumn("bucket", bucket)
    following = (
        W.partitionBy("column_name", "bucket").orderBy(F.desc("at")).rangeBetween(W.unboundedPreceding, 0)
    )
    # one row for each bucket of shares
    least = both.groupBy("column_name", "bucket").agg(F.min("target").alias("least"))
    after = W.partitionBy("column_name").orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    later = least.select("column_name", "bucket", F.min("least").over(after).alias("later"))
    found = both.withColumn("within", F.min("target").over(following)).where(F.col("row").isNotNull())
    return found.join(later, ["column_name", "bucket"]).select(
        "row.*", F.coalesce("within", "later").alias("cross")
    )


def numeric_drift(counts: DataFrame, buckets: int = 64) -> DataFrame:
    """First Wasserstein distance per day and column, in reference deviations.

    ``counts`` come from :func:`value_counts_by_day`. The distance is the area between
    both cumulative shares. The reference is added up once: between two values of a day
    the day's share is constant, and the reference crosses it in one place, so the area
    there follows from three points of the reference's integral. No reference value is
    copied to a day.
    """
    reference, current = _areas(counts, buckets)
    reference, current = materialize(reference, "reference"), materialize(current, "current")
    totals = current.groupBy("day", "column_name").agg(F.sum("n").alias("total"))
    along = running_over_buckets(
        current.select("day", "column_name", "value", "n", "area", "mean", "bucket"),
        group=["day", "column_name"],
        bucket="bucket",
        order=["value"],
        sums={"upto_n": F.col("n")},
        leads={"next_value": "value", "next_area": "area"},
    )
    steps = along.join(totals, ["day", "column_name"]).select(
        "day", "column_name", "value", "area", "mean", "next_value", "next_area",
        (F.col("upto_n") == F.col("n")).alias("is_first"),
        (F.col("upto_n") / F.col("total")).alias("upto"),
    )
    crossed = _crossings(reference, steps, buckets)
    a, b, q = F.col("value"), F.col("next_value"), F.col("upto")
    inside = F.struct(F.col("cross.value").alias("x"), F.col("cross.area").alias("area"))
    at = (
        F.when(F.col("cross.value") <= a, F.struct(a.alias("x"), F.col("area")))
        .when(F.col("cross.value") >= b, F.struct(b.alias("x"), F.col("next_area").alias("area")))
        .otherwise(inside)
    )
    between = q * (2 * at["x"] - a - b) + F.col("area") + F.col("next_area") - 2 * at["area"]
    # below the day's first value lies the reference's area, above its last what is left to 1
    before = F.when(F.col("is_first"), F.col("area")).otherwise(0.0)
    beyond = F.col("mean") - a + F.col("area")
    distance = F.sum(before + F.when(b.isNull(), beyond).otherwise(between))
    return (
        crossed.groupBy("day", "column_name")
        .agg(distance.alias("distance"))
        .join(_deviations(counts), "column_name")
        .select(
            "day", "column_name", (F.greatest("distance", F.lit(0.0)) / F.col("std")).alias("drift_score")
        )
    )


def categorical_drift(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (natural logarithm) of the shares per day and column.

    A day brings its own labels only. What the reference has besides them adds its
    share times ln 2, whatever the labels are, so no label is copied to a day. A column
    without any label that day has no score.
    """
    known = counts.where(F.col("label").isNotNull())
    share = lambda keys: F.col("n") / F.sum("n").over(W.partitionBy(*keys))
    # one row per label: both windows hold a column's labels, not its rows
    reference = known.where(F.col("day").isNull()).select(
        "column_name", "label", share(["column_name"]).alias("p")
    )
    current = known.where(F.col("day").isNotNull()).select(
        "day", "column_name", "label", share(["day", "column_name"]).alias("q")
    )
    p, q = F.coalesce("p", F.lit(0.0)), F.col("q")
    middle = (p + q) / F.lit(2.0)
    part = lambda x: F.when(x > 0, x * F.ln(x / middle)).otherwise(F.lit(0.0))
    unseen = F.greatest(F.lit(1.0) - F.sum(p), F.lit(0.0)) * F.lit(math.log(2.0))
    divergence = (F.sum(part(p) + part(q)) + unseen) / F.lit(2.0)
    return (
        current.join(reference, ["column_name", "label"], "left")
        .groupBy("day", "column_name")
        .agg(F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("drift_score"))
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    numerical: Sequence[str] = NUMERICAL_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    threshold: float = COLUMN_DRIFT_THRESHOLD,
) -> DataFrame:
    """Drift score and flag per day and column; ``current`` has a ``day`` column.

    The value counts are written once; both kinds of scores read them.
    """
    counts = materialize(
        value_counts_by_day(reference, current, numerical, categorical), "value-counts"
    )
    scores = numeric_drift(counts).unionByName(categorical_drift(counts))
    return scores.select(
        F.col("day").cast("timestamp_ntz").alias("timestamp"),
        "column_name",
        "drift_score",
        (F.col("drift_score") > threshold).alias("is_drift"),
    )


def drift_summary(drift: DataFrame, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """Number and share of drifted columns per day, and whether the day drifted."""
    drifted = F.col("is_drift").cast("int")
    return (
        drift.groupBy("timestamp")
        .agg(
            F.sum(drifted).cast("int").alias("number_of_drifted_columns"),
            F.avg(drifted).alias("share_of_drifted_columns"),
        )
        .select("*", (F.col("share_of_drifted_columns") > share).alias("dataset_drift"))
    )


def daily_performance(scored: DataFrame, target: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """RMSE, mean and largest absolute error per day; ``scored`` has a ``day`` column."""
    return scored.groupBy(F.col("day").cast("timestamp_ntz").alias("timestamp")).agg(
        rmse(target, prediction).alias("rmse"),
        mae(target, prediction).alias("mae"),
        max_abs_error(target, prediction).alias("abs_error_max"),
    )


# --- dashboards ---------------------------------------------------------------


def drift_over_time(drift: DataFrame, column_name: str = "stock") -> DataFrame:
    return (
        drift.where(F.col("column_name") == column_name)
        .select(F.col("timestamp").alias("time"), "drift_score", "column_name")
        .orderBy("time")
    )


def performance_over_time(performance: DataFrame) -> DataFrame:
    return performance.select(F.col("timestamp").alias("time"), "rmse", "mae").orderBy("time")


def day_series(stock: DataFrame, day: str, station: str) -> DataFrame:
    """One station's stock over one day, per type, in time order."""
    chosen = (F.to_date("time") == F.lit(day).cast("date")) & (F.col("station") == station)
    return stock.where(chosen).select("time", "rideable_type", "stock").orderBy("rideable_type", "time")
