"""Each registered query against its SQL, over whole tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tallymart.oracle import ORACLE
from tallymart.queries import QUERIES

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def in_order(names, table):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(normal(row[i]) for i in order) for row in table)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    got = in_order(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(contract.oracle_sql()[name])
    expected = in_order([c[0] for c in result.description], result.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) > 0
    assert got[1] == expected[1]


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
