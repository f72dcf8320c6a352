import pytest
from check import compare, sql_engine

from wickwork.llm.oracle import SQL
from wickwork.llm.queries import REGISTRY


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, name):
    ok, note = compare(REGISTRY[name](spark, folder), sql_engine(folder), SQL[name])
    assert ok, note
