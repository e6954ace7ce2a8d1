"""Every query against its SQL counterpart, over whole tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tenurelog.bindings.oracle import ORACLE
from tenurelog.bindings.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    return (1, str(value))


def rows(names, data):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in at], sorted(tuple(canonical(row[i]) for i in at) for row in data)


def test_same_keys():
    assert set(QUERIES) == set(ORACLE) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    want = rows([c[0] for c in cursor.description], cursor.fetchall())
    got = rows(df.columns, [tuple(row) for row in df.collect()])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "a query over the test tables must return rows"


def test_entry(spark):
    assert contract.entry(spark).count() > 0
