"""Runs a query and its SQL side by side and compares them as sets of rows."""

import datetime
import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, datetime.datetime):
        return str(x.replace(tzinfo=None))
    if isinstance(x, datetime.date):
        return f"{x} 00:00:00"
    if isinstance(x, list):
        return str([plain(y) for y in x])
    v = float(x)
    return "nan" if math.isnan(v) else round(v, 9)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in found)


def check(df, sql, connection):
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    want = connection.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    want = rows(names, want.fetchall())
    assert got == want, f"{sum(got.values())} and {sum(want.values())} rows; only here: {list((got - want).items())[:2]}; only there: {list((want - got).items())[:2]}"
