"""Run a query in Spark and its SQL twin in DuckDB and compare the rows, whatever their order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql) -> str | None:
    """None when both agree, otherwise what differs."""
    con.execute(sql)
    sql_names = [d[0] for d in con.description]
    sql_types = {d[0]: str(d[1]) for d in con.description}
    theirs_rows = con.fetchall()
    if sorted(sql_names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(sql_names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    wrong = {c: (t, sql_types[c]) for c, t in df.dtypes if kinds.get(t) != sql_types[c]}
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(sql_names, theirs_rows)
    if mine != theirs:
        a, b = list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
        return (
            f"rows {mine.total()} vs {theirs.total()}; {(mine - theirs).total()} only here {a}; "
            f"{(theirs - mine).total()} only there {b}"
        )
    return f"types {wrong}" if wrong else None
