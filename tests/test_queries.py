import pytest
from check import compare, sql_engine

import __spark_entry__ as entry
from wickwork.plans import oracle
from wickwork.plans.queries import REGISTRY
from wickwork.schemas import FEATURE_COLUMNS

QUERIES, SQL = entry.queries(), oracle.SQL


@pytest.fixture(scope="module")
def con(folder):
    return sql_engine(folder)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == FEATURE_COLUMNS
    assert df.count() > 0


def test_only_the_forest_has_no_sql():
    assert set(REGISTRY) - set(SQL) == {"forest_predictions"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, con, name):
    ok, note = compare(QUERIES[name](spark, folder), con, SQL[name])
    assert ok, note


def test_forest_predictions(spark, folder):
    rows = QUERIES["forest_predictions"](spark, folder).collect()
    assert rows and all(r.confidence in ("High", "Low") for r in rows)
