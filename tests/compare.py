"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def _canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(value)
    return str(value)


def by_name(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(row[i]) for i in order) for row in rows)


def compare(spark, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    ours = by_name(df.columns, df.collect())
    columns, rows = oracle_rows(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return f"columns {df.columns} against {columns}"
    theirs = by_name(columns, rows)
    if ours == theirs:
        return None
    only_ours = sorted(set(ours) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} rows against {len(theirs)}; {only_ours} against {only_theirs}"
