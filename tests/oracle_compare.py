"""Compare a Spark result with a DuckDB result: columns, row count, sorted values."""

from __future__ import annotations

import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if v is None or isinstance(v, (int, str, bool)):
        return v
    return str(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(sdf, con, sql):
    cols = sdf.columns
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(norm(r[i]) for i in idx) for r in res.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a, b = sorted(srows, key=key), sorted(drows, key=key)
    assert len(a) == len(b)
    assert a == b
    return len(a)
