"""A query's rows against those of its SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(data: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{data}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def rows(columns: list[str], values: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tidy = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(repr(tuple(tidy(r[i]) for i in order)) for r in values)


def same(df, sql: str, data: str) -> None:  # noqa: ANN001
    want = connection(data).sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows(want.columns, want.fetchall())
