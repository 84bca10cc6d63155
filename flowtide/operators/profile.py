"""Table profiles, missing values, histograms, correlation."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_column(df: DataFrame, measures: dict) -> DataFrame:
    """One aggregate over the table, turned into one row per column."""
    one_row = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[m(c).alias(f"{name}__{c}") for name, m in measures.items() for c in df.columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                *[F.col(f"`{name}__{c}`").alias(name) for name in measures],
            )
            for c in df.columns
        ]
    )
    return one_row.select(F.explode(entries).alias("e"), "row_count").select("e.*", "row_count")


def profile(df: DataFrame) -> DataFrame:
    """Type, non-null count and row count of every column."""
    return _per_column(df, {"non_null_count": F.count})


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, {"null_count": lambda c: F.count_if(F.col(c).isNull())}).drop("data_type")


def rows_with_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows in which any of the columns is NULL."""
    missing = F.lit(False)
    for c in subset or df.columns:
        missing = missing | F.col(c).isNull()
    return df.where(missing)


def mixed_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What kinds of values text columns hold: missing, numbers, other text."""
    number = lambda c: F.col(c).try_cast("double").isNotNull()
    return _per_column(
        df.select(*columns),
        {
            "n_missing": lambda c: F.count_if(F.col(c).isNull()),
            "n_numeric": lambda c: F.count_if(number(c)),
            "n_text": lambda c: F.count_if(F.col(c).isNotNull() & ~number(c)),
        },
    ).drop("data_type")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def unique_check(df: DataFrame, column: str) -> DataFrame:
    """One row: is every row's value of ``column`` its own?

    Counted by value first, with map-side combine, so that neither a repeated
    value nor the set of all values meets in one task.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(column).alias("n_distinct")
    )
    return totals.select("*", (F.col("n_distinct") == F.col("n_rows")).alias("is_unique"))


def histogram(
    df: DataFrame,
    column: str,
    bins: int | None = None,
    width: float | None = None,
) -> DataFrame:
    """Counts per bin: ``bins`` equal bins from the minimum to the maximum, or
    bins of a fixed ``width`` from a multiple of it.

    Bins are closed on the left; the last of ``bins`` holds the maximum too.
    Empty bins are part of the result.
    """
    if (bins is None) == (width is None):
        raise ValueError("give either bins or width")
    value = F.col(column).cast("double")
    present = df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("value"))
    span = present.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    if bins is not None:
        # equal values get a range of one around them
        pad = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
        span = span.select((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi"))
        step = (F.col("s.hi") - F.col("s.lo")) / F.lit(float(bins))
        lower, last = F.col("s.lo"), F.lit(bins - 1)
        raw = F.least(F.floor((F.col("value") - lower) / step), last)
        # rounding may put a value next to an edge one bin off; the edges decide
        raw = (
            F.when(F.col("value") < lower + raw * step, raw - 1)
            .when((raw < last) & (F.col("value") >= lower + (raw + 1) * step), raw + 1)
            .otherwise(raw)
        )
        numbers = F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))
    else:
        step, lower = F.lit(float(width)), F.lit(0.0)
        raw = F.floor(F.col("value") / step)
        numbers = F.sequence(F.floor(F.col("s.lo") / step), F.floor(F.col("s.hi") / step))
    bounds = span.select(F.struct("lo", "hi").alias("s")).scalar()
    counts = (
        present.select("value", bounds.alias("s"))
        .select(raw.cast("bigint").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # the bins come from the same scalar, which is computed once
    one_row = df.sparkSession.range(1).select(bounds.alias("s")).where("s.lo IS NOT NULL")
    edges = one_row.select("s", F.explode(numbers).alias("bin")).select(
        "bin",
        (lower + F.col("bin") * step).alias("lower_edge"),
        (lower + (F.col("bin") + 1) * step).alias("upper_edge"),
    )
    return edges.join(counts, "bin", "left").na.fill(0, ["n"])


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass over the table.

    A row takes part in the pairs for which it has both values. Each pair is one
    aggregate, so rows are neither repeated nor shuffled.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    of = lambda c: F.col(c).cast("double")
    once = df.agg(*[F.corr(of(a), of(b)).alias(str(k)) for k, (a, b) in enumerate(pairs)])
    long = once.unpivot([], [F.col(f"`{k}`") for k in range(len(pairs))], "pair", "correlation")
    named = [F.array(*[F.lit(pair[side]) for pair in pairs]) for side in (0, 1)]
    at = F.col("pair").cast("int")
    return long.select(
        F.get(named[0], at).alias("column_a"), F.get(named[1], at).alias("column_b"), "correlation"
    )
