"""Vector autoregressions of many groups of series, all fitted in one job.

A group (a station, say) has a few series (its types). Products of lags and values are
added up for a group and month in tasks, merged by Spark as rows (group, i, j, sum), and
the normal equations of a group are solved in the task that gets its sums. Neither the
driver nor a plan holds a coefficient: they are a table, which the forecast joins.
"""

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.constants import SLOT_MINUTES, TRAIN_FRACTION, VAR_MAX_LAGS
from flowtide.operators.forecast import split_time

GROUPS = ("station",)
NAME = "rideable_type"


def _lagged(stock: DataFrame, groups: Sequence[str], name: str, lags: int) -> DataFrame:
    """Every slot of every series: its change ``y`` and the changes of the slots before, nearest first."""
    along = W.partitionBy(*groups, name).orderBy("time")
    change = (F.col("stock") - F.lag("stock", 1).over(along)).cast("double")
    changes = stock.select("time", *groups, F.col(name).alias("name"), "stock", change.alias("y"))
    along = W.partitionBy(*groups, "name").orderBy("time")
    before = F.array(*[F.lag("y", k).over(along) for k in range(1, lags + 1)]).cast("array<double>")
    return changes.select("*", F.lag("stock", 1).over(along).alias("previous"), before.alias("x"))


def _names(stock: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Of every group: the names of its series, in order."""
    return stock.groupBy(*groups).agg(F.sort_array(F.collect_set(name)).alias("names"))


def _matrix(rows: pd.DataFrame, names: list[str], lags: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots that all series have, in order: changes, and changes by slot, lag and series."""
    k = len(names)
    rows = rows.sort_values(["time", "name"])
    whole = rows.groupby("time")["name"].transform("size") == k
    rows = rows[whole]
    y = rows["y"].to_numpy(float).reshape(-1, k)
    x = np.array([[np.nan if v is None else v for v in r] for r in rows["x"]], float).reshape(-1, k, lags)
    return y, x.swapaxes(1, 2)


def _products(rows: pd.DataFrame, keys: list[str], lags: int) -> pd.DataFrame:
    """Sums of products of one group and month, of the columns 1, lags and values; the upper half.

    Slots from before the first complete one give no products; of these the changes
    themselves are handed on, at (-1 - slot, series), since a lower order can use them.
    """
    y, x = _matrix(rows, list(rows["names"].iloc[0]), lags)
    complete = ~(np.isnan(y).any(axis=1) | np.isnan(x).any(axis=(1, 2)))
    z = np.hstack([np.ones((complete.sum(), 1)), x[complete].reshape(complete.sum(), lags * y.shape[1]), y[complete]])
    i, j = np.triu_indices(z.shape[1])
    found = pd.DataFrame({"i": i, "j": j, "s": (z.T @ z)[i, j]})
    early = ~complete & ~np.isnan(y).any(axis=1)
    if early.any():
        # a slot's number: how many changes are known before it
        slots = (~np.isnan(x[early]).any(axis=2)).sum(axis=1)
        found = pd.concat(
            [found, *(pd.DataFrame({"i": -1 - n, "j": np.arange(y.shape[1]), "s": v}) for n, v in zip(slots, y[early], strict=True))]
        )
    return found.assign(**{c: rows[c].iloc[0] for c in keys}, k=y.shape[1])[[*keys, "k", "i", "j", "s"]]


def _solve(gram: np.ndarray, order: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and residual products of the columns 1 and ``order`` lags."""
    z, y = np.arange(1 + order * k), np.arange(len(gram) - k, len(gram))
    zy = gram[np.ix_(z, y)]
    # least squares: a series that never moves makes the matrix singular
    beta = np.linalg.lstsq(gram[np.ix_(z, z)], zy, rcond=None)[0]
    return beta, gram[np.ix_(y, y)] - zy.T @ beta


def _criteria(residual: np.ndarray, n: float, order: int) -> tuple[float, float]:
    k = len(residual)
    sign, log_det = np.linalg.slogdet(residual / n) if n else (0.0, -math.inf)
    free = order * k * k + k
    log_det = log_det if sign > 0 else -math.inf
    return log_det + 2.0 / max(n, 1) * free, log_det + math.log(max(n, 1)) / max(n, 1) * free


def _fitted(sums: pd.DataFrame, lags: int, order: int | None) -> tuple[int, float, float, float, np.ndarray]:
    """The order with the least criterion on the common slots, fitted on all its own."""
    k = int(sums["k"].iloc[0])
    size = 1 + lags * k + k
    products = sums[sums["i"] >= 0]
    gram = np.zeros((size, size))
    gram[products["i"], products["j"]] = products["s"]
    gram = gram + np.triu(gram, 1).T
    if order is None:
        order = min(range(lags + 1), key=lambda p: _criteria(_solve(gram, p, k)[1], gram[0, 0], p)[0])
    early = sums[sums["i"] < 0].sort_values(["i", "j"], ascending=[False, True])["s"].to_numpy(float).reshape(-1, k)
    for t in range(order, len(early)):
        row = np.zeros(size)
        row[0], row[1 : 1 + order * k], row[-k:] = 1, early[t - order : t][::-1].ravel(), early[t]
        gram += np.outer(row, row)
    beta, residual = _solve(gram, order, k)
    return order, gram[0, 0], *_criteria(residual, gram[0, 0], order), beta


def fit_groups(
    stock: DataFrame, groups: Sequence[str] = GROUPS, name: str = NAME, max_lags: int = VAR_MAX_LAGS,
    order: int | None = None, fraction: float | None = TRAIN_FRACTION, slot_minutes: int = SLOT_MINUTES,
) -> DataFrame:
    """A row for every group and series: its equation on first differences.

    ``groups..., name, lag_order, n, aic, bic, intercept, weights``: weights has lag 1 of
    all series of the group by name, then lag 2, and so on. Every group takes the order
    up to ``max_lags`` with the least AIC on the slots that have all lags, or ``order``,
    and is then fitted on all slots that have that many. Series must be gap-free; slots
    that not all series of a group have are left out. With ``fraction`` only the training
    slots are used. Groups too short for an equation get one of zeros. Lazy; ``stock`` is
    passed over three times.
    """
    keys, lags = list(groups), max_lags if order is None else order
    if fraction is not None:
        stock = stock.where(F.col("time") < split_time(stock, fraction, slot_minutes))
    month = F.date_trunc("month", "time").cast("date").alias("month")
    rows = _lagged(stock, keys, name, lags).join(_names(stock, keys, name), keys).select("*", month)
    key_types = ", ".join(f"`{c}` {stock.schema[c].dataType.simpleString()}" for c in keys)

    def products(rows: pd.DataFrame) -> pd.DataFrame:
        return _products(rows, keys, lags)

    def solved(sums: pd.DataFrame) -> pd.DataFrame:
        found, n, aic, bic, beta = _fitted(sums, lags, order)
        made = {c: [sums[c].iloc[0]] * beta.shape[1] for c in keys}
        made |= {"position": range(beta.shape[1]), "lag_order": found, "n": int(n), "aic": aic, "bic": bic}
        return pd.DataFrame(made | {"intercept": beta[0], "weights": list(beta[1:].T)})

    partial = rows.groupBy(*keys, "month").applyInPandas(products, f"{key_types}, k int, i int, j int, s double")
    sums = partial.groupBy(*keys, "k", "i", "j").agg(F.sum("s").alias("s"))
    fitted = sums.groupBy(*keys).applyInPandas(
        solved, f"{key_types}, position int, lag_order int, n bigint, aic double, bic double, intercept double, "
        "weights array<double>"
    )
    named = _names(stock, keys, name).select(*keys, F.posexplode("names").alias("position", name))
    return fitted.join(named, [*keys, "position"]).select(
        *keys, name, "lag_order", "n", "aic", "bic", "intercept", "weights"
    )


def coefficients(model: DataFrame, groups: Sequence[str] = GROUPS, name: str = NAME) -> DataFrame:
    """``groups..., name, lag, source, weight``: the intercept is lag 0 without a source."""
    keys = list(groups)
    names = model.groupBy(*keys).agg(F.sort_array(F.collect_list(name)).alias("names"))
    rows = model.join(names, keys).select(
        *keys, name, "intercept", "names", F.posexplode_outer("weights").alias("at", "weight")
    )
    k = F.size("names")
    lags = rows.where(F.col("at").isNotNull()).select(
        *keys, name, (F.floor(F.col("at") / k) + 1).cast("int").alias("lag"),
        F.get("names", F.col("at") % k).alias("source"), "weight",
    )
    return lags.unionByName(
        model.select(*keys, name, F.lit(0).alias("lag"), F.lit(None).cast("string").alias("source"),
                     F.col("intercept").alias("weight"))
    )


def forecast_groups(
    stock: DataFrame, model: DataFrame, groups: Sequence[str] = GROUPS, name: str = NAME,
    max_lags: int = VAR_MAX_LAGS, fraction: float | None = TRAIN_FRACTION, slot_minutes: int = SLOT_MINUTES,
) -> DataFrame:
    """``time, groups..., name, actual, predicted`` one step ahead, over the held-out slots.

    All inputs are actual values: the last one plus the predicted change. ``max_lags`` is
    no less than any order of ``model``. Slots without enough lags, or that not all series
    of the group have, and groups without a model have no forecast.
    """
    keys = list(groups)
    lagged = _lagged(stock, keys, name, max_lags)
    if fraction is not None:
        lagged = lagged.where(F.col("time") >= split_time(stock, fraction, slot_minutes))
    cell = F.struct("name", "stock", "previous", "x")
    slots = lagged.groupBy(*keys, "time").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    # lag by lag, all series
    lags = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(max_lags - 1)), lambda l: F.transform("cells", lambda c: F.get(c["x"], l))))
    design = slots.select(*keys, "time", "cells", lags.alias("x"))
    equations = model.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), "intercept", "weights"))).alias("equations")
    )
    joined = design.join(equations, keys)
    same = F.transform("cells", lambda c: c["name"]) == F.transform("equations", lambda e: e["name"])
    both = joined.where(same).select(*keys, "time", "x", F.explode(F.arrays_zip("cells", "equations")).alias("e"))
    weights = F.col("e.equations.weights")
    used = F.slice("x", F.lit(1), F.size(weights))
    moved = F.aggregate(
        F.zip_with(used, weights, lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v
    )
    predicted = F.col("e.cells.previous") + F.col("e.equations.intercept") + moved
    return both.select(
        "time", *keys, F.col("e.cells.name").alias(name), F.col("e.cells.stock").alias("actual"),
        predicted.alias("predicted"),
    ).where(F.col("predicted").isNotNull())
