"""Every query against its SQL in DuckDB, value by value."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from cleargrist.suite.oracle import ORACLE_SQL
from cleargrist.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    yield connection
    connection.close()


def comparable(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(comparable(row[i]) for i in order) for row in rows)


def test_every_query_has_sql_and_the_reverse():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    actual = multiset(result.columns, result.collect())
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = multiset(columns, cursor.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert actual == expected
    assert actual, "a query without rows checks nothing"


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "name_cleaned",
        "manufacturer_name_cleaned",
        "category_cleaned",
        "item_count",
        "avg_price",
        "min_price",
        "max_price",
    ]
    assert result.count() > 0
