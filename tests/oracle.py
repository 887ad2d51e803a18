"""Runs a query and its SQL twin and compares them as multisets of typed rows."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(folder: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return db


def _plain(x):
    if isinstance(x, float):
        return None if x != x else round(x, 6) + 0.0
    if isinstance(x, Decimal):
        return format(x, "f")
    if isinstance(x, (date, datetime)):
        return str(x)
    if isinstance(x, (list, tuple)):
        return tuple(_plain(v) for v in x)
    return x


def rows(names: list[str], values) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in values)


def compare(df, db, sql: str) -> None:
    told = db.execute(sql)
    names = [c[0] for c in told.description]
    assert sorted(names) == sorted(df.columns)
    here, there = rows(df.columns, df.collect()), rows(names, told.fetchall())
    assert here == there, f"only here: {list((here - there).items())[:3]}; only there: {list((there - here).items())[:3]}"
