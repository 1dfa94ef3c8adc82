"""Every query of the subpackage that SQL can say, against DuckDB over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import assert_same
from lendwatch.llm import registry

TABLES = "documents embeddings pages benchmark labels"


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_duckdb(spark, small, duck, name):
    assert_same(registry.QUERIES[name](spark, small), duck, registry.ORACLE_SQL[name])


def test_all_are_registered():
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
