"""Holds a query against its SQL in DuckDB: columns by name, rows as a multiset, floats by a few digits."""

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return x.as_integer_ratio() if hasattr(x, "as_tuple") else x


def differences(df, connection, sql: str) -> str:
    want = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(want.columns):
        return f"columns {names} and {sorted(want.columns)}"
    place = [want.columns.index(n) for n in names]
    a = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    b = Counter(tuple(plain(r[k]) for k in place) for r in want.fetchall())
    if a == b:
        return ""
    return f"{sum(a.values())} and {sum(b.values())} rows; only in Spark {list((a - b).items())[:3]}, only in SQL {list((b - a).items())[:3]}"
