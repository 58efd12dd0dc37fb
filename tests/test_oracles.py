"""Every query against its SQL counterpart in DuckDB, over the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from larder import catalog

TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(row):
    return tuple(
        (value is not None, "nan" if isinstance(value, float) and math.isnan(value) else value)
        for value in row
    )


def test_every_query_has_an_oracle():
    # text operators that SQL cannot express have tests of their own
    assert catalog.QUERIES.keys() <= ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(name, spark, duck):
    found = QUERIES[name](spark, TABLES)
    wanted = duck.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    types = dict(zip(wanted.columns, map(str, wanted.types)))
    assert dict(found.dtypes) == {c: KINDS.get(types[c], types[c]) for c in columns}
    ours = sorted(comparable(row) for row in found.select(*columns).collect())
    theirs = sorted(comparable(row) for row in wanted.select(*columns).fetchall())
    assert ours, "an empty result proves nothing"
    assert len(ours) == len(theirs)
    assert ours == theirs
