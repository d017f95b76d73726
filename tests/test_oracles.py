"""Every registered query against its DuckDB SQL, exactly, on the smallest data."""

import pytest
from check_oracles import oracle_connection, oracle_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return oracle_connection(data)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows_as_sql(spark, data, duck, key):
    assert spark_rows(QUERIES[key](spark, data)) == oracle_rows(duck, ORACLES[key])


def test_flagship(spark):
    assert entry(spark).columns == ["region_name", "revenue"]
    assert entry(spark).count() == 5
