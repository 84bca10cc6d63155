"""Autoregressions of groups against the single fit of the library and least squares of NumPy."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtide.operators import forecast, var_groups

START = datetime(2024, 1, 30)


def walk(seed, slots, k):
    rng = np.random.default_rng(seed)
    y = np.zeros((slots, k))
    for t in range(2, slots):
        y[t] = 0.4 * y[t - 1] - 0.2 * y[t - 2][::-1] + rng.normal(size=k)
    return np.rint(10 * y.cumsum(axis=0)).astype(int)


def table(spark, groups):
    rows = [
        (START + timedelta(minutes=15 * t), g, f"t{j}", int(v))
        for g, stock in groups.items()
        for t, row in enumerate(stock)
        for j, v in enumerate(row)
    ]
    return spark.createDataFrame(rows, "time timestamp_ntz, station string, rideable_type string, stock bigint")


def plain(stock, order):
    """Intercept and weights of every series, by least squares on the rows themselves."""
    y = np.diff(stock, axis=0).astype(float)
    z = np.array([[1, *y[t - order : t][::-1].ravel()] for t in range(order, len(y))])
    return np.linalg.lstsq(z, y[order:], rcond=None)[0], len(z)


@pytest.fixture(scope="module")
def groups():
    return {"a": walk(1, 400, 2), "b": walk(2, 400, 2), "one": walk(3, 400, 1), "still": np.full((400, 2), 7)}


def equations(model):
    found = {}
    for r in model.orderBy("station", "rideable_type").collect():
        found.setdefault(r["station"], []).append(r)
    return found


def test_fixed_order_equals_least_squares(spark, groups):
    found = equations(var_groups.fit_groups(table(spark, groups), order=2, fraction=None))
    assert {g: len(rows) for g, rows in found.items()} == {"a": 2, "b": 2, "one": 1, "still": 2}
    for g, rows in found.items():
        beta, n = plain(groups[g], 2)
        for j, row in enumerate(rows):
            assert [row["intercept"], *row["weights"]] == pytest.approx(beta[:, j].tolist(), abs=1e-8)
            assert (row["n"], row["lag_order"]) == (n, 2)


def test_chosen_order_equals_the_single_fit(spark, groups):
    for g in ("a", "one"):
        stock = table(spark, {g: groups[g]}).cache()
        single = forecast.fit_var(stock, max_lags=5)
        rows = equations(var_groups.fit_groups(stock, max_lags=5))[g]
        assert rows[0]["lag_order"] == single.lag_order
        assert [r["intercept"] for r in rows] == pytest.approx(single.intercept.tolist())
        assert np.array([r["weights"] for r in rows]) == pytest.approx(single.coefficients)
        assert (rows[0]["aic"], rows[0]["bic"]) == pytest.approx((single.aic, single.bic))
        ours = var_groups.forecast_groups(stock, var_groups.fit_groups(stock, max_lags=5), max_lags=5)
        theirs = forecast.var_forecast(stock, single)
        key = ["time", "station", "rideable_type"]
        both = ours.join(theirs.withColumnRenamed("predicted", "p"), [*key, "actual"])
        assert both.count() == theirs.count() == ours.count() > 0
        assert both.where(F.abs(F.col("p") - F.col("predicted")) > 1e-8).count() == 0


def test_two_hundred_groups(spark):
    many = {f"g{i}": walk(i, 120, 2) for i in range(200)}
    found = equations(var_groups.fit_groups(table(spark, many), order=1, fraction=None))
    assert len(found) == 200
    for g in ("g0", "g77", "g199"):
        beta, _ = plain(many[g], 1)
        assert [r["intercept"] for r in found[g]] == pytest.approx(beta[0].tolist(), abs=1e-8)


def test_coefficients_as_rows(spark, groups):
    stock = table(spark, {"a": groups["a"]})
    rows = var_groups.coefficients(var_groups.fit_groups(stock, order=2, fraction=None)).collect()
    beta, _ = plain(groups["a"], 2)
    found = {(r["rideable_type"], r["lag"], r["source"]): r["weight"] for r in rows}
    assert len(rows) == 10
    assert found["t0", 0, None] == pytest.approx(beta[0, 0])
    assert found["t1", 2, "t0"] == pytest.approx(beta[3, 1])


def test_short_groups_gaps_and_empty_tables(spark, groups):
    stock = table(spark, {"a": groups["a"], "short": walk(5, 2, 2)})
    found = equations(var_groups.fit_groups(stock, order=2, fraction=None))
    assert found["short"][0]["n"] == 0 and found["short"][0]["weights"] == [0.0] * 4
    # of a slot that one series lacks nothing is learned or forecast
    gone = stock.where("NOT (station = 'a' AND rideable_type = 't1' AND time = '2024-01-31 00:00:00')")
    model = var_groups.fit_groups(gone, order=1, fraction=None)
    assert var_groups.forecast_groups(gone, model, max_lags=1, fraction=None).where(
        "time = '2024-01-31 00:00:00'"
    ).count() == 0
    nothing = var_groups.fit_groups(stock.limit(0), order=1, fraction=None)
    assert nothing.count() == 0 and var_groups.forecast_groups(stock, nothing, fraction=None).count() == 0
