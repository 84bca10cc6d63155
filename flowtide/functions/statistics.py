"""Aggregate and scalar expressions used by several operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def z_score(value: Column, mean: Column, spread: Column) -> Column:
    """NULL when the spread is zero or unknown."""
    return F.try_divide(value - mean, spread)


def rmse(actual: Column | str, predicted: Column | str) -> Column:
    error = _col(actual) - _col(predicted)
    return F.sqrt(F.avg(error.cast("double") * error))


def mae(actual: Column | str, predicted: Column | str) -> Column:
    return F.avg(F.abs(_col(actual) - _col(predicted)))


def max_abs_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.max(F.abs(_col(actual) - _col(predicted))).cast("double")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
