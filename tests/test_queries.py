"""Every registered query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from keyed_lake.plans import oracles, queries

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    return connection


def text(value):
    return "NULL" if value is None else repr(round(value, 6)) if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(queries.registered()) == set(oracles.registered())
    assert set(queries.registered()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", queries.registered())
def test_query(spark, db, name):
    df = entry_points.queries()[name](spark, SF)
    columns = sorted(df.columns)
    sql = db.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    assert sorted(names) == columns
    expected = sorted([text(r[names.index(c)]) for c in columns] for r in sql.fetchall())
    assert sorted([text(r[c]) for c in columns] for r in df.collect()) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() == 15
