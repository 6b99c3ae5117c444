"""Spark's rows against DuckDB's on the same tables."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder):
    c = duckdb.connect()
    for t in TABLES:
        p = Path(folder, f"{t}.parquet")
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5) + 0.0
    return x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, folder, query, sql):
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = connection(folder).execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    assert len(got) == len(want), (len(got), len(want))
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, bad[:3]
    return len(got)
