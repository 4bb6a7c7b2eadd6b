"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(x):
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        return repr(x + 0.0) if x else "0.0"
    if isinstance(x, bool) or x is None or isinstance(x, (int, str)):
        return repr(x)
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """None when both sides agree, else a text that tells the difference."""
    df = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    duck_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    a, b = rows_of(df.columns, spark_rows), rows_of(names, duck_rows)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        return f"{len(differing)} of {len(a)} rows differ, first {differing[0]} ({sorted(names)})"
    if not a:
        return "no rows"
    return None
