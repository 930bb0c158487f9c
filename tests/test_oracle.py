"""Every registered query against DuckDB over the same Parquet files."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield con
    con.close()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


def test_every_query_has_an_oracle():
    own = {name for name, query in QUERIES.items() if not query.__module__.startswith("barlake.llm")}
    assert own <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    got_rows = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got_rows == rows(want.columns, want.fetchall())
    assert got_rows


def test_entry(spark):
    assert entry.entry(spark).count() == 150
