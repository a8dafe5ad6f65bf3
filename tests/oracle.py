"""Comparison of a Spark result with DuckDB on the same Parquet files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results hold the same rows under the same names."""
    theirs = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(theirs.columns):
        return f"columns differ: {names} and {sorted(theirs.columns)}"
    order = [theirs.columns.index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in theirs.fetchall())
    actual = Counter(tuple(row[n] for n in names) for row in df.collect())
    if actual == expected:
        kinds = lambda rows, i: {type(r[i]) for r in rows if r[i] is not None}
        for i, n in enumerate(names):
            if kinds(actual, i) != kinds(expected, i):
                return f"types of {n} differ: {kinds(actual, i)} and {kinds(expected, i)}"
        return None
    only = list((actual - expected).items())[:3], list((expected - actual).items())[:3]
    return f"{actual.total()} and {expected.total()} rows; only here: {only[0]}; only there: {only[1]}"
