"""Merged moments against NumPy on whole columns."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtide.operators import comoments
from flowtide.session import materialize

COLUMNS = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    a = 1e6 + rng.normal(size=500)  # far from zero: sums of squares alone would lose it
    x = np.stack([a, 3 * a + rng.normal(size=500), rng.lognormal(size=500), np.full(500, 4.0)], axis=1)
    x[rng.random(x.shape) < 0.1] = np.nan
    return x


@pytest.fixture(scope="module")
def table(spark, values):
    rows = [
        (None if i % 50 == 0 else date(2024, 1, 1) + timedelta(days=i % 7), *(None if np.isnan(v) and i % 2 else float(v) for v in r))
        for i, r in enumerate(values)
    ]
    return spark.createDataFrame(rows, "on date, a double, b double, c double, flat double").repartition(5)


def test_days_merge_into_the_whole(spark, table, values):
    daily = materialize(comoments.merge(materialize(comoments.partial_moments(table, COLUMNS, F.col("on")), "p"), ["day"]), "d")
    assert daily.select("day").distinct().count() == 8  # rows without a day are a group too
    whole = materialize(comoments.merge(daily), "w")
    found = {(r["column_a"], r["column_b"]): r["correlation"] for r in comoments.correlations(whole).collect()}
    assert len(found) == 6
    for (a, b), got in found.items():
        x = values[:, [COLUMNS.index(a), COLUMNS.index(b)]]
        x = x[~np.isnan(x).any(axis=1)]
        if "flat" in (a, b):
            assert got is None
        else:
            assert got == pytest.approx(np.corrcoef(x.T)[0, 1], abs=1e-9)
    for r in comoments.deviations(whole).collect():
        x = values[:, COLUMNS.index(r["column"])]
        x = x[~np.isnan(x)]
        assert (r["n"], r["mean"], r["std"]) == (len(x), pytest.approx(x.mean()), pytest.approx(x.std(ddof=1), abs=1e-7))


def test_a_new_day_needs_no_old_rows(spark, table):
    old, new = table.where("on < '2024-01-05'"), table.where("on >= '2024-01-05'")
    stored = comoments.partial_moments(old, COLUMNS, F.col("on")).unionByName(
        comoments.partial_moments(new, COLUMNS, F.col("on"))
    )
    both = comoments.merge(materialize(stored, "both")).orderBy(*comoments.PAIR).collect()
    whole = materialize(comoments.partial_moments(table.where("on IS NOT NULL"), COLUMNS), "whole")
    for x, y in zip(both, comoments.merge(whole).orderBy(*comoments.PAIR).collect(), strict=True):
        assert x[:3] == y[:3] and list(x[3:]) == pytest.approx(list(y[3:]))


def test_empty(table):
    assert comoments.merge(comoments.partial_moments(table.limit(0), COLUMNS)).count() == 0
