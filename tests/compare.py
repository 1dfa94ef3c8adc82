"""Run a registered query and its DuckDB statement and compare every value."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def assert_same(df, connection, sql):
    columns = sorted(df.columns)
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    assert sorted(described) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    quoted = [f"`{c}`" for c in columns]
    ours = [tuple(r) for r in df.select(*quoted).collect()]
    names = ", ".join(f'"{c}"' for c in columns)
    theirs = connection.execute(f"SELECT {names} FROM ({sql})").fetchall()
    assert _sorted(ours) == _sorted(theirs)
