"""Every query against its SQL on the given tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"
TABLES = [p.stem for p in Path(SF_DIR).glob("*.parquet")]


def normal(value):
    if value is None:
        return (0,)
    if isinstance(value, (float, Decimal)):
        return (1, "nan" if math.isnan(value) else f"{float(value):.9g}")
    return (2, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR)
    wanted = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, wanted.fetchall())


def test_every_query_has_sql():
    assert contract.QUERIES.keys() == contract.ORACLE.keys()
