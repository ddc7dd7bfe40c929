"""Row-for-row comparison of a Spark result with its SQL oracle."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _normal_type(name: str) -> str:
    name = name.lower()
    for ours, theirs in (("string", "varchar"), ("bigint", "bigint"), ("int", "integer")):
        if name == theirs:
            return ours
    return name.replace(" ", "")


def difference(df, connection, sql: str) -> str | None:
    """None when names, types and multisets of rows agree, else what differs."""
    expected = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(expected.columns):
        return f"columns {names} against {sorted(expected.columns)}"
    ours = {c: _normal_type(t) for c, t in df.dtypes}
    theirs = {c: _normal_type(str(t)) for c, t in zip(expected.columns, expected.types)}
    if ours != theirs:
        return f"types {[(c, ours[c], theirs[c]) for c in names if ours[c] != theirs[c]]}"
    place = [expected.columns.index(c) for c in names]
    want = Counter(tuple(row[i] for i in place) for row in expected.fetchall())
    got = Counter(tuple(row[c] for c in names) for row in df.collect())
    if want == got:
        return None
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"only ours {list((got - want).items())[:3]}; only oracle {list((want - got).items())[:3]}"
    )
