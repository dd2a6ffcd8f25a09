"""Compare a Spark result with its SQL oracle, value by value."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Return a list of differences, empty if both agree."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    out = []
    if sorted(df.columns) != sorted(want_cols):
        return [f"columns {sorted(df.columns)} != {sorted(want_cols)}"]
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    a, b = rows_of(df.columns, got), rows_of(want_cols, want)
    if a != b:
        out.append(f"only spark {sum((a - b).values())}: {list((a - b))[:3]}")
        out.append(f"only sql {sum((b - a).values())}: {list((b - a))[:3]}")
    if not got:
        out.append("no rows")
    return out
