"""Rows of Spark and of DuckDB in one form."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return f"{float(v):.9g}"
    return str(v)


def in_order(rows, names):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in at) for row in rows)


def sql_rows(sf_dir, sql):
    con = duckdb.connect()
    for f in Path(sf_dir).iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(names), in_order(found.fetchall(), names)


def spark_rows(df):
    return sorted(df.columns), in_order(df.collect(), df.columns)
