"""Drift from mergeable sketches: a table of one small row a day and column instead of the rows.

A row holds the number of values, their mean and squared deviations, and a KLL sketch of
their distribution. Rows merge into rows of the same kind, so a reference of any span of days
comes from the table, and a new day adds its own rows and reads no others. The exact scores are
:func:`flowtide.operators.drift.numeric_drift`.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.operators.drift import SMALLEST_SPREAD

# Size of a sketch, which sets its error (:func:`rank_error`).
SKETCH_K = 2048
# Places at which two distributions are compared.
STEPS = 2000


def rank_error(k: int = SKETCH_K) -> float:
    """How far the share of values below a value may be off, in 99 of 100 sketches: published for KLL."""
    return 2.296 / k**0.9021


def sketches(df: DataFrame, columns: Sequence[str], by: Column, k: int = SKETCH_K) -> DataFrame:
    """``day, column_name, n, mean, m2, sketch`` of the known values; ``by`` is a date or NULL.

    One pass over the rows, combined before the shuffle: a day with a third of all rows sends
    as many rows as any other. NULL and NaN do not count; a day without a value has no row.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    rows = df.select(by.cast("date").alias("day"), F.explode(F.array(*cells)).alias("cell")).select("day", "cell.*")
    known = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("day", "column_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
    )


def merge_sketches(rows: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Rows of the same column (and ``by``) merged into one, by the parallel update rule."""
    weighted, total = F.sum(F.col("n") * F.col("mean")), F.sum("n")
    # between the groups: sum of n (mean - all)^2, taken around a value that lies among them
    away = F.col("mean") - F.col("_near")
    between = F.sum(F.col("n") * away * away) - F.pow(F.sum(F.col("n") * away), 2) / total
    near = rows.groupBy(*by, "column_name").agg(F.min("mean").alias("_near"))
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in (*by, "column_name")]
    both = rows.alias("r").join(near.alias("t"), on).select("r.*", "_near")
    return both.groupBy(*by, "column_name").agg(
        total.alias("n"),
        (weighted / total).alias("mean"),
        (F.sum("m2") + F.greatest(between, F.lit(0.0))).alias("m2"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
    )


def sketch_drift(reference: DataFrame, days: DataFrame, steps: int = STEPS) -> DataFrame:
    """``day, column_name, drift_score``: first Wasserstein distance in reference deviations.

    ``reference`` is one row a column (:func:`merge_sketches`), ``days`` one a day and column. The
    distance is the mean gap between both distributions' values at equal shares, over ``steps``
    shares. Each sketch is off by a share of :func:`rank_error`, in 99 of 100 cases, and the shares
    by 1 / (2 steps), so the distance is off by their sum times the width of the values met;
    columns that only one side has get no score.
    """
    # the shares must be a constant: one literal, and not one for each
    shares = F.split(F.lit(" ".join(str((i + 0.5) / steps) for i in range(steps))), " ").cast("array<double>")
    values = lambda side: F.kll_sketch_get_quantile_double(f"{side}.sketch", shares)
    gaps = F.zip_with(values("d"), values("r"), lambda x, y: F.abs(x - y))
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap) / steps
    # both means are exact, and no distance is less than what lies between them
    distance = F.greatest(distance, F.abs(F.col("d.mean") - F.col("r.mean")))
    std = F.greatest(F.sqrt(F.col("r.m2") / F.col("r.n")), F.lit(SMALLEST_SPREAD))
    met = days.alias("d").join(reference.alias("r"), F.col("d.column_name") == F.col("r.column_name"))
    return met.select(F.col("d.day").alias("day"), F.col("d.column_name").alias("column_name"), (distance / std).alias("drift_score"))
