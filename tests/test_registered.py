"""Every registered query against DuckDB on the small test tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(item):
        if isinstance(item, float):
            return "nan" if math.isnan(item) else f"{item:.10g}"
        return f"{type(item).__name__}:{item}"

    return [columns[i] for i in order], sorted(tuple(value(row[i]) for i in order) for row in data)


def test_every_oracle_has_its_query_and_the_librarys_own_queries_all_have_one():
    assert driver.oracle_sql().keys() <= driver.queries().keys()
    assert driver.QUERIES.keys() == driver.ORACLES.keys()


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = driver.queries()[name](spark, FOLDER)
    answer = duck.execute(driver.oracle_sql()[name])
    wanted = comparable([column[0] for column in answer.description], answer.fetchall())
    assert comparable(result.columns, result.collect()) == wanted
    assert wanted[1], "a query over the test tables returns rows"


def test_entry(spark):
    assert driver.entry(spark).columns == ["region", "total_trips", "total_revenue"]
