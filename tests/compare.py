"""Runs one registered query in Spark and its SQL in DuckDB, and compares all rows."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck_rows(sql, folder):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = db.sql(sql)
    return canonical(result.columns, result.fetchall())


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])
