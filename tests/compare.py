"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import pathlib

import duckdb

TABLES = ("lineitem", "orders", "customer", "nation")
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = pathlib.Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Same names, types and rows, counting repeats; returns the number of rows."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {row[0]: row[1] for row in described}
    assert {name: TYPES[kind] for name, kind in df.dtypes} == types

    columns = ", ".join(f'"{name}"' for name in sorted(types))
    con.execute(f"CREATE OR REPLACE TEMP TABLE want AS SELECT {columns} FROM ({sql})")
    got_arrow = df.toArrow()
    con.register("got_arrow", got_arrow)
    con.execute(f"CREATE OR REPLACE TEMP TABLE got AS SELECT {columns} FROM got_arrow")
    con.unregister("got_arrow")

    missing = con.execute("SELECT * FROM want EXCEPT ALL SELECT * FROM got LIMIT 5").fetchall()
    surplus = con.execute("SELECT * FROM got EXCEPT ALL SELECT * FROM want LIMIT 5").fetchall()
    assert (missing, surplus) == ([], [])
    return got_arrow.num_rows
