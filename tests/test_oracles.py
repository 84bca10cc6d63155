"""Every query against its SQL on the smallest tables, and its plan for bad joins."""

from pathlib import Path

import pytest

from checks.compare import database, difference
from checks.oracles import oracle_sql
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {
        "var_fit", "var_forecast", "var_rmse_by_series", "gbt_fit_score", "gbt_importance",
        "gbt_deep", "search_models", "boosted_fit_score", "boosted_importance",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    assert difference(spark, QUERIES[name], SQL[name], db, FOLDER) is None


def test_entry(spark):
    from __spark_entry__ import entry

    table = entry(spark)
    assert table.count() > 0 and table.columns[:3] == ["station", "rideable_type", "stock"]
