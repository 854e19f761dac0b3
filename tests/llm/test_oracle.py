"""Every query of the subpackage against its SQL, where it has one."""

import math

import duckdb
import pytest

from pulsegauge.llm.catalog import REGISTERED
from pulsegauge.llm.oracle import ORACLE


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


@pytest.fixture(scope="module")
def database(tables):
    connection = duckdb.connect()
    for name in ("documents", "pages", "conversations", "embeddings"):
        connection.execute(f"create view {name} as select * from '{tables}/{name}.parquet'")
    yield connection
    connection.close()


def test_the_queries_are_the_thirteen():
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTERED) == list(range(1, 14))
    assert set(ORACLE) <= set(REGISTERED)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, tables, database, name):
    found = REGISTERED[name](spark, tables)
    wanted = database.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    place = [wanted.columns.index(c) for c in columns]
    wanted_rows = sorted(tuple(plain(row[i]) for i in place) for row in wanted.fetchall())
    found_rows = sorted(tuple(map(plain, row)) for row in found.select(columns).collect())
    assert found_rows == wanted_rows
