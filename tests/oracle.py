"""Compare a registered query with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from glob import glob
from os.path import basename

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str):
    """``(columns equal, rows only in Spark, rows only in DuckDB, rows)``."""
    mine, got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    theirs, want = rows_of([d[0] for d in result.description], result.fetchall())
    return mine == theirs, got - want, want - got, sum(got.values())
