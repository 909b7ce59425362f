"""Every registered query that has an SQL twin against it, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import compare

FOLDER = contract.SMOKE_DIR
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


# The queries without a twin fit models; the forest, text and pipeline tests cover them.
@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, db, name):
    ours = QUERIES[name](spark, FOLDER).toArrow()
    assert ours.num_rows > 0
    assert compare(ours, db.sql(ORACLE[name]).to_arrow_table()) == "ok"


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
