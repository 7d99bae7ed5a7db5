"""Rows of a Spark query beside those of its SQL over the same Parquet tables."""

import datetime
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

DATA = "/root/testdata/sf0.001"


def plain(value):
    """A value that is equal on both sides: numbers by nine digits, times as text."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        return float(f"{float(value):.9g}") if math.isfinite(value) else str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def counted(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def same(df, sql, folder=DATA):
    with duckdb.connect() as db:
        db.sql("SET TimeZone = 'UTC'")
        for p in Path(folder).glob("*.parquet"):
            db.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        found = db.sql(sql)
        columns, rows = found.columns, found.fetchall()
    assert sorted(df.columns) == sorted(columns)
    got, want = counted(df.columns, df.collect()), counted(columns, rows)
    assert got == want, f"only in Spark: {list((got - want).items())[:3]}; only in SQL: {list((want - got).items())[:3]}"
    return len(rows)
