"""Run a query and its SQL twin and compare the rows regardless of order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v))
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    return int(v) if isinstance(v, int) else str(v)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(
        tuple(_value(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()
    )


def rows_of_sql(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_value(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows
