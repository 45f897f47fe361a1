"""Every query equals its SQL on the same parquet tables."""

import os
import pathlib

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


# DuckDB's name for each Spark type the results use (fixed values).
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    result = queries()[name](spark, SF_DIR)
    ours = canonical(result.columns, [tuple(r) for r in result.collect()])
    found = db.execute(oracle_sql()[name])
    theirs = canonical([d[0] for d in found.description], found.fetchall())
    assert ours[0] == theirs[0]
    assert {n: TYPES[t] for n, t in result.dtypes} == {d[0]: str(d[1]) for d in found.description}
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
    assert ours[1], "an empty result checks nothing"


def test_entry(spark):
    assert entry(spark).count() > 0
