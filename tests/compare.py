"""Run a registered query in Spark and its check SQL in DuckDB and compare the rows."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if x is None or x is pd.NaT:
        return ""
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return "" if x != x else repr(x)
    return str(x)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Problems found; empty when columns, row count and all values agree."""
    res = con.execute(sql)
    dcols = [c[0] for c in res.description]
    drows = rows_of(dcols, res.fetchall())
    scols = spark_df.columns
    srows = rows_of(scols, [tuple(r) for r in spark_df.collect()])
    problems = []
    if sorted(scols) != sorted(dcols):
        return [f"columns {sorted(scols)} vs {sorted(dcols)}"]
    if len(srows) != len(drows):
        problems.append(f"rows {len(srows)} vs {len(drows)}")
    bad = [(a, b) for a, b in zip(srows, drows) if a != b]
    if bad:
        problems.append(f"{len(bad)} differing rows, first: spark={bad[0][0]} duck={bad[0][1]}")
    if not srows:
        problems.append("no rows")
    return problems
