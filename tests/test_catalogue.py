"""Every catalogue query with an SQL twin gives the same rows as that SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as catalogue

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def comparable(value):
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value) + 0.0
    return value


def table_of(rows, order):
    return sorted(repr([comparable(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = catalogue.queries()[name](spark, FOLDER)
    cursor = sql.execute(catalogue.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = table_of(cursor.fetchall(), [columns.index(c) for c in sorted(columns)])
    got = table_of(df.collect(), [df.columns.index(c) for c in sorted(columns)])
    assert got == expected


def test_entry_has_rows(spark):
    assert catalogue.entry(spark).count() > 0
