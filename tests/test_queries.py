"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry_module

duckdb = pytest.importorskip("duckdb")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [name[: -len(".parquet")] for name in sorted(os.listdir(SF)) if name.endswith(".parquet")]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted((tuple(row[at] for at in order) for row in rows), key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "decimal(20,6)": "DECIMAL(20,6)",
}


@pytest.mark.parametrize("name", sorted(entry_module.QUERIES))
def test_query_equals_sql(spark, sql, name):
    got = entry_module.queries()[name](spark, SF)
    want = sql.sql(entry_module.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert {c: KINDS[t] for c, t in got.dtypes} == kinds
    rows, expected = got.collect(), want.fetchall()
    assert len(rows) == len(expected) > 0
    assert canonical(got.columns, rows) == canonical(want.columns, expected)


def test_every_query_has_sql():
    assert set(entry_module.QUERIES) == set(entry_module.SQL)


def test_entry(spark):
    assert entry_module.entry(spark).columns[-2:] == ["filename", "size_in_kb"]
