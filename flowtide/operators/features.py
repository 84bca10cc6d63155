"""Calendar, lag and target features; encodings; sequences."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.constants import (
    LAGS,
    SEQUENCE_LOOKBACK,
    SERIES,
    SLOT_MINUTES,
    TARGET,
    lag_column,
)
from flowtide.functions.calendar import (
    is_rush_hour,
    monday_based_weekday,
    scaled_date,
    slot_hours,
)

def series_order():
    return W.partitionBy(*SERIES).orderBy("time")


def calendar_features(stock: DataFrame, rush: str = "closed") -> DataFrame:
    """Hour, weekday (Monday is 0), rush flag and scaled date of ``time``.

    ``rush`` is "closed" (as in training) or "half_open" (as in scoring): they
    differ at 10:00 and 19:00.
    """
    hour = slot_hours("time")
    return stock.select(
        "*",
        hour.alias("hour"),
        monday_based_weekday("time").alias("dayofweek"),
        is_rush_hour(hour, closed=_closed(rush)).alias("is_rush_hour"),
        scaled_date("time").alias("date"),
    )


def _closed(rush: str) -> bool:
    if rush not in ("closed", "half_open"):
        raise ValueError(f"rush must be closed or half_open, not {rush!r}")
    return rush == "closed"


def lag_features(
    stock: DataFrame, lags: int = LAGS, slot_minutes: int = SLOT_MINUTES
) -> DataFrame:
    """Stock of the ``lags`` slots before and of the slot after, per series.

    All columns share one window, hence one sort.
    """
    return stock.select(
        "*",
        *[
            F.lag("stock", k).over(series_order()).alias(lag_column(k, slot_minutes))
            for k in range(1, lags + 1)
        ],
        F.lead("stock", 1).over(series_order()).alias(TARGET),
    )


def features(
    stock: DataFrame,
    lags: int = LAGS,
    rush: str = "closed",
    drop_null: bool = True,
    keep_time: bool = False,
    slot_minutes: int = SLOT_MINUTES,
) -> DataFrame:
    """The model's feature table. Lags run across midnight.

    ``keep_time`` keeps the slot, which the ordered split and the daily metrics
    need; the feature set itself is without it.
    """
    table = calendar_features(lag_features(stock, lags, slot_minutes), rush)
    columns = [
        *(["time"] if keep_time else []),
        *SERIES,
        "stock",
        "hour",
        "dayofweek",
        "is_rush_hour",
        *[lag_column(k, slot_minutes) for k in range(1, lags + 1)],
        TARGET,
        "date",
    ]
    table = table.select(*columns)
    return table.na.drop("any") if drop_null else table


def stock_diff(stock: DataFrame) -> DataFrame:
    """Change of stock against the slot before; NULL at the start of a series."""
    change = F.col("stock") - F.lag("stock", 1).over(series_order())
    return stock.select("*", change.alias("stock_diff"))


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a column, for operators that make columns of them."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)


def one_hot(df: DataFrame, values: dict[str, Sequence[str] | None]) -> DataFrame:
    """Replace each column by one 0/1 column per value, named column_value.

    Values left out (None) are read from the data first.
    """
    chosen = {c: list(v) if v is not None else categories(df, c) for c, v in values.items()}
    return df.select(
        *[c for c in df.columns if c not in chosen],
        *[
            F.coalesce(F.col(c) == v, F.lit(False)).cast("int").alias(f"{c}_{v}")
            for c, vs in chosen.items()
            for v in vs
        ],
    )


def _ranges(df: DataFrame, columns: Sequence[str]):
    pairs = df.agg(
        *[
            F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
            for c in columns
        ]
    )
    return pairs.select(F.struct(*columns).alias("r")).scalar()


def min_max_scale(
    df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None
) -> DataFrame:
    """Columns moved to [0, 1]; a constant column becomes 0.

    The ranges come from ``fitted_on``, or from ``df`` itself.
    """
    ranges = _ranges(fitted_on if fitted_on is not None else df, columns)
    scaled = {}
    for c in columns:
        lo, hi = ranges[c]["lo"], ranges[c]["hi"]
        width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        scaled[c] = (F.col(c) - lo) / width
    return df.select(*[scaled.get(c, F.col(c)).alias(c) for c in df.columns])


def min_max_restore(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame) -> DataFrame:
    """Inverse of :func:`min_max_scale`."""
    ranges = _ranges(fitted_on, columns)
    restored = {
        c: F.col(c)
        * F.when(ranges[c]["hi"] == ranges[c]["lo"], F.lit(1.0)).otherwise(
            ranges[c]["hi"] - ranges[c]["lo"]
        )
        + ranges[c]["lo"]
        for c in columns
    }
    return df.select(*[restored.get(c, F.col(c)).alias(c) for c in df.columns])


def sequences(
    table: DataFrame,
    inputs: Sequence[str],
    target: str = TARGET,
    lookback: int = SEQUENCE_LOOKBACK,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Per row with a full history: the ``lookback`` rows before it, and its target.

    ``window`` is an array of structs of ``inputs``, oldest first, one array per
    row and never longer than ``lookback``.
    """
    along = W.partitionBy(*series).orderBy("time")
    before = along.rowsBetween(-lookback, -1)
    return table.select(
        "time",
        *series,
        F.collect_list(F.struct(*inputs)).over(before).alias("window"),
        F.col(target).alias("target"),
    ).where(F.size("window") == lookback)
