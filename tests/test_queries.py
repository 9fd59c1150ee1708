"""Every registered query against its SQL in DuckDB, over whole tables."""

import pytest

import __spark_entry__ as driver
from queries.catalog import QUERIES
from queries.oracles import ORACLES
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, sf_dir, duck, name):
    sql = ORACLES[name]
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, duck, sql) is None
    sql_types = {row[0]: row[1] for row in duck.execute("describe " + sql).fetchall()}
    assert {column: DUCK_TYPES[kind] for column, kind in df.dtypes} == sql_types


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
