"""Means, variances and correlations from mergeable rows, one a day and pair of columns.

A batch of rows becomes, for every pair of columns, the number of rows that have both,
their means, squared deviations and products of deviations. Rows of this kind merge by
the parallel update rule into the same kind, so a month's matrix comes from its days, and
a new day is added without reading the others again.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = ("column_a", "column_b")
MOMENTS = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "c_ab")


def _moments(rows: pd.DataFrame, columns: Sequence[str]) -> pd.DataFrame:
    """Of one batch, for each pair with a not after b; products of matrices, centred first."""
    x = rows[list(columns)].to_numpy(float)
    known = ~np.isnan(x)
    centre = np.where(known.any(axis=0), np.where(known, x, 0).sum(axis=0) / np.maximum(known.sum(axis=0), 1), 0.0)
    x, one = np.where(known, x - centre, 0.0), known.astype(float)
    n, sums, squares, products = one.T @ one, x.T @ one, (x * x).T @ one, x.T @ x
    a, b = np.triu_indices(len(columns))
    a, b = (i[n[a, b] > 0] for i in (a, b))
    count = n[a, b]
    names = np.array(columns, object)
    return pd.DataFrame(
        {
            "column_a": names[a],
            "column_b": names[b],
            "n": count.astype(np.int64),
            "mean_a": sums[a, b] / count + centre[a],
            "mean_b": sums[b, a] / count + centre[b],
            "m2_a": squares[a, b] - sums[a, b] ** 2 / count,
            "m2_b": squares[b, a] - sums[b, a] ** 2 / count,
            "c_ab": products[a, b] - sums[a, b] * sums[b, a] / count,
        }
    )


def merge(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the same pair (and ``by``) merged into one. Store ``moments``: it is read twice."""
    keys = [*by, *PAIR]
    weighted = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(f"all_{c}")
    means = moments.groupBy(*keys).agg(weighted("mean_a"), weighted("mean_b"))
    away = {s: F.col(f"mean_{s}") - F.col(f"all_mean_{s}") for s in "ab"}
    on = [F.col(f"m.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    both = moments.alias("m").join(means.alias("t"), on).select("m.*", "all_mean_a", "all_mean_b")
    return both.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.first("all_mean_a").alias("mean_a"),
        F.first("all_mean_b").alias("mean_b"),
        F.sum(F.col("m2_a") + F.col("n") * away["a"] * away["a"]).alias("m2_a"),
        F.sum(F.col("m2_b") + F.col("n") * away["b"] * away["b"]).alias("m2_b"),
        F.sum(F.col("c_ab") + F.col("n") * away["a"] * away["b"]).alias("c_ab"),
    )


def partial_moments(df: DataFrame, columns: Sequence[str], by: Column | None = None) -> DataFrame:
    """``day, column_a, column_b`` and the moments, a row or more each: merge them after storing.

    A pair takes the rows that have both values; NaN counts as missing. ``by`` is a date,
    null for rows that belong to none. A pair without rows has no row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for day, rows in batch.groupby("day", dropna=False):
                made = _moments(rows, columns)
                made.insert(0, "day", None if pd.isna(day) else day)
                yield made

    day = (F.lit(None) if by is None else by).cast("date").alias("day")
    rows = df.select(day, *[F.col(c).cast("double").alias(c) for c in columns])
    kinds = ", ".join(f"{c} {'bigint' if c == 'n' else 'double'}" for c in MOMENTS)
    return rows.mapInPandas(run, f"day date, column_a string, column_b string, {kinds}")


def correlations(moments: DataFrame) -> DataFrame:
    """``column_a, column_b, correlation`` of every pair of two columns; NULL without spread."""
    spread = F.sqrt(F.col("m2_a") * F.col("m2_b"))
    return moments.where("column_a <> column_b").select(*PAIR, F.try_divide("c_ab", spread).alias("correlation"))


def deviations(moments: DataFrame) -> DataFrame:
    """``column, n, mean, std`` of every column: the sample deviation, NULL of one row."""
    std = F.sqrt(F.try_divide("m2_a", F.col("n") - 1))
    return moments.where("column_a = column_b").select(F.col("column_a").alias("column"), "n", F.col("mean_a").alias("mean"), std.alias("std"))
