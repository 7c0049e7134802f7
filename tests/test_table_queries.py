"""Every registered query against DuckDB on the smallest supplied tables."""

import duckdb
import pytest

from tests.conftest import SMALL
from threatloom.plans.table_queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'").fetchall()
    return connection


def ordered(records):
    return sorted(records, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = ordered(tuple(r[c] for c in columns) for r in df.collect())
    if name not in SQL:
        assert got
        return
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = ordered(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert got == expected
