"""Naive forecast, seasonal decomposition, vector autoregression.

Most functions pass over the series more than once (for its span, for a fit), so
give them a stored series, as the tables module writes it.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.constants import (
    SEASON_PERIOD,
    SERIES,
    SLOT_MINUTES,
    TRAIN_FRACTION,
    VAR_MAX_LAGS,
)
from flowtide.functions.statistics import rmse
from flowtide.operators.reshape import SEPARATOR, series_names


def split_time(stock: DataFrame, fraction: float = TRAIN_FRACTION, slot_minutes: int = SLOT_MINUTES):
    """First test slot of a gap-free grid: int(fraction * slots) slots after its start."""
    seconds = slot_minutes * 60
    span = stock.agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    slots = F.timestamp_diff("SECOND", F.col("lo"), F.col("hi")) / F.lit(seconds) + 1
    skip = F.floor(slots * F.lit(fraction)) * F.lit(seconds)
    return span.select((F.col("lo") + F.make_dt_interval(secs=skip)).alias("t")).scalar()


def naive_forecast(stock: DataFrame, lag: int = 1, fraction: float | None = TRAIN_FRACTION) -> DataFrame:
    """Stock of ``lag`` slots before as the forecast, over the held-out slots.

    The first ``lag`` held-out slots have no forecast and are left out.
    ``fraction=None`` forecasts the whole series.
    """
    held_out = stock if fraction is None else stock.where(F.col("time") >= split_time(stock, fraction))
    previous = F.lag("stock", lag).over(W.partitionBy(*SERIES).orderBy("time"))
    return held_out.select(
        "time", *SERIES, F.col("stock").alias("actual"), previous.alias("predicted")
    ).where(F.col("predicted").isNotNull())


def overall_rmse(forecast: DataFrame) -> DataFrame:
    return forecast.agg(rmse("actual", "predicted").alias("rmse"), F.count(F.lit(1)).alias("n"))


def rmse_by_series(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy(*SERIES).agg(
        rmse("actual", "predicted").alias("rmse"), F.count(F.lit(1)).alias("n")
    )


def seasonal_decompose(stock: DataFrame, period: int = SEASON_PERIOD) -> DataFrame:
    """Additive decomposition: trend, seasonal and residual part per series.

    The trend is a centred moving average over one period (half weight at both
    ends when the period is even) and NULL within half a period of the ends. The
    seasonal part is the mean of what is left per phase, less the mean over the
    phases.
    """
    along = W.partitionBy(*SERIES).orderBy("time")
    half = period // 2
    if period % 2 == 0:
        inner = F.sum("stock").over(along.rowsBetween(1 - half, half - 1))
        ends = F.lag("stock", half).over(along) + F.lead("stock", half).over(along)
        total = inner + ends * F.lit(0.5)
    else:
        total = F.sum("stock").over(along.rowsBetween(-half, half))
    complete = F.lag(F.lit(1), half).over(along).isNotNull() & F.lead(F.lit(1), half).over(along).isNotNull()
    position = F.row_number().over(along) - 1
    trended = stock.select(
        "time",
        *SERIES,
        "stock",
        F.when(complete, total / F.lit(float(period))).alias("trend"),
        position.alias("position"),
        (position % period).alias("phase"),
    )
    # windows by series and phase keep the rows where they are; a join would not
    left = F.avg(F.col("stock") - F.col("trend")).over(W.partitionBy(*SERIES, "phase"))
    phased = trended.select("*", left.alias("phase_mean"))
    once = F.when(F.col("position") < period, F.col("phase_mean"))
    seasonal = F.col("phase_mean") - F.avg(once).over(W.partitionBy(*SERIES))
    return phased.select("time", *SERIES, "stock", "trend", seasonal.alias("seasonal")).select(
        "*", (F.col("stock") - F.col("trend") - F.col("seasonal")).alias("residual")
    )


# --- vector autoregression ---------------------------------------------------


@dataclass(frozen=True)
class VarModel:
    """A fitted vector autoregression on first differences."""

    names: tuple[str, ...]
    lag_order: int
    intercept: np.ndarray  # one per series
    coefficients: np.ndarray  # series x (lag_order * series), most recent lag first
    criteria: tuple[tuple[int, float, float], ...]  # lag order, AIC, BIC on the common sample
    aic: float = math.nan  # of the final fit, which has more rows
    bic: float = math.nan


def var_design(
    stock: DataFrame, names: Sequence[str], lags: int, fraction: float | None = None
) -> DataFrame:
    """Per slot: the differences ``y`` of all series and those of ``lags`` slots before.

    ``names`` are all series, sorted. ``x`` holds lag 1 of every series, then lag 2,
    and so on. Lags are taken within each series before the series meet in one
    row, so no task sorts a whole table. With ``fraction`` only the training slots
    are used.
    """
    if fraction is not None:
        stock = stock.where(F.col("time") < split_time(stock, fraction))
    along = W.partitionBy(*SERIES).orderBy("time")
    diffs = stock.select(
        "time",
        *SERIES,
        "stock",
        F.lag("stock", 1).over(along).alias("previous"),
        (F.col("stock") - F.lag("stock", 1).over(along)).cast("double").alias("y"),
    )
    lagged = diffs.select(
        "time",
        F.concat_ws(SEPARATOR, *SERIES).alias("name"),
        "stock",
        "previous",
        "y",
        F.array(*[F.lag("y", k).over(along) for k in range(1, lags + 1)])
        .cast("array<double>")
        .alias("x"),
    )
    # one row per slot: an array of its series, in the order of their names
    cell = F.struct("name", "stock", "previous", "y", "x")
    slots = lagged.groupBy("time").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    row = slots.where(F.size("cells") == len(names)).select(
        "time",
        F.col("cells.stock").alias("stock"),
        F.col("cells.previous").alias("previous"),
        F.col("cells.y").alias("y"),
        F.concat(
            F.array().cast("array<double>"),
            *[F.transform("cells", _lag_of(k)) for k in range(lags)],
        ).alias("x"),
    )
    complete = F.forall("x", lambda v: v.isNotNull()) & F.forall("y", lambda v: v.isNotNull())
    return row.where(complete)


def _lag_of(k: int):
    # a function of one argument: transform passes the index to a second one
    return lambda cell: cell["x"][k]


def fit_var(
    stock: DataFrame,
    max_lags: int = VAR_MAX_LAGS,
    fraction: float | None = TRAIN_FRACTION,
    names: Sequence[str] | None = None,
) -> VarModel:
    """Fit by least squares; the lag order up to ``max_lags`` has the least AIC.

    All orders are compared on the slots that have ``max_lags`` lags; the chosen
    order is then fitted on all its slots. Spark reduces the design to its
    Gram matrix, whose size depends on the number of series only; the driver
    solves the normal equations of that matrix.
    """
    names = tuple(sorted(names)) if names is not None else tuple(series_names(stock))
    k = len(names)
    gram = _gram(var_design(stock, names, max_lags, fraction))
    n = gram[0, 0]
    criteria = [(p, *_information(_solve(gram, p, k)[1], n, p)) for p in range(max_lags + 1)]
    order = min(criteria, key=lambda c: c[1])[0]
    final = _gram(var_design(stock, names, order, fraction)) if order < max_lags else gram
    beta, left = _solve(final, order, k)
    return VarModel(names, order, beta[0], beta[1:].T, tuple(criteria), *_information(left, final[0, 0], order))


def _information(residual: np.ndarray, n: float, order: int) -> tuple[float, float]:
    """AIC and BIC from the residual cross products of ``n`` rows."""
    k = len(residual)
    log_det = np.linalg.slogdet(residual / n)[1]
    free = order * k * k + k
    return log_det + 2.0 / n * free, log_det + math.log(n) / n * free


def _gram(design: DataFrame) -> np.ndarray:
    """Z'Z of Z = [1, x, y], summed by the executors."""
    rows = design.select(array_to_vector(F.concat(F.array(F.lit(1.0)), "x", "y")).alias("z"))
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "z"))
    return matrix.computeGramianMatrix().toArray()


def _solve(gram: np.ndarray, order: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and residual cross products for the first ``order`` lags."""
    z = np.arange(1 + order * k)
    y = np.arange(gram.shape[0] - k, gram.shape[0])
    zy = gram[np.ix_(z, y)]
    # least squares: a series that never moves makes the matrix singular
    beta = np.linalg.lstsq(gram[np.ix_(z, z)], zy, rcond=None)[0]
    return beta, gram[np.ix_(y, y)] - zy.T @ beta


def var_summary(stock: DataFrame, model: VarModel) -> DataFrame:
    """One row: the chosen order, and AIC and BIC of the final fit."""
    row = (model.lag_order, len(model.names), float(model.aic), float(model.bic))
    return stock.sparkSession.createDataFrame([row], "lag_order int, n_series int, aic double, bic double")


def var_criteria(stock: DataFrame, model: VarModel) -> DataFrame:
    """AIC and BIC per lag order and which order was chosen."""
    rows = [(p, float(a), float(b), p == model.lag_order) for p, a, b in model.criteria]
    schema = "lag_order int, aic double, bic double, is_chosen boolean"
    return stock.sparkSession.createDataFrame(rows, schema)


def var_forecast(
    stock: DataFrame, model: VarModel, fraction: float | None = TRAIN_FRACTION
) -> DataFrame:
    """One step ahead over the held-out slots: last actual plus predicted change.

    Every input is an actual value, so the roll through time is a projection.
    """
    design = var_design(stock, model.names, model.lag_order)
    if fraction is not None:
        design = design.where(F.col("time") >= split_time(stock, fraction))
    cells = []
    for i, name in enumerate(model.names):
        station, rideable_type = name.rsplit(SEPARATOR, 1)
        weights = F.array(*[F.lit(float(w)) for w in model.coefficients[i]])
        moved = F.aggregate(
            F.zip_with("x", weights, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
        )
        cells.append(
            F.struct(
                F.lit(station).alias("station"),
                F.lit(rideable_type).alias("rideable_type"),
                F.col("stock")[i].alias("actual"),
                (F.col("previous")[i] + moved + F.lit(float(model.intercept[i]))).alias("predicted"),
            )
        )
    return design.select("time", F.explode(F.array(*cells)).alias("c")).select("time", "c.*")
