"""Compare a query with its SQL on the same parquet tables, as sets of rows."""

from __future__ import annotations

import math
import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(db, df, sql):
    """Empty when both sides agree; otherwise a readable description."""
    relation = db.sql(sql)
    want_cols, want = rows_of(relation.columns, relation.fetchall())
    got_cols, got = rows_of(df.columns, df.collect())
    if want_cols != got_cols:
        return f"columns differ: spark {got_cols}, sql {want_cols}"
    if want != got:
        extra, missing = list((got - want).items())[:4], list((want - got).items())[:4]
        return f"rows {sum(got.values())} vs {sum(want.values())}; only spark {extra}; only sql {missing}"
    return ""
