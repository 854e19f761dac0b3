"""Every registered query against its SQL, run by DuckDB on the same tables."""

import math
from datetime import date, datetime

import duckdb
import pytest

from __spark_entry__ import queries
from pulsegauge.plans.catalog import REGISTERED
from pulsegauge.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def database(tables):
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{tables}/events.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat(timespec="microseconds")
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


# Spark type to DuckDB type.
SAME = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTERED) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, tables, database, name):
    found = queries()[name](spark, tables)
    wanted = database.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    types = dict(found.dtypes)
    wanted_types = dict(zip(wanted.columns, map(str, wanted.types)))
    assert {c: SAME[types[c]] for c in columns} == wanted_types
    place = [wanted.columns.index(c) for c in columns]
    wanted_rows = sorted(tuple(plain(row[i]) for i in place) for row in wanted.fetchall())
    found_rows = sorted(tuple(map(plain, row)) for row in found.select(columns).collect())
    assert len(found_rows) == len(wanted_rows)
    differing = [pair for pair in zip(found_rows, wanted_rows) if pair[0] != pair[1]]
    assert not differing, differing[:5]
    # The smallest tables have no partition with a high lag.
    assert found_rows or (name == "consumer_lag_high" and tables.endswith("sf0.001"))
