"""Compare a query with its SQL as the driver does."""

import duckdb
import math


def both(spark, query, sql, d):
    con = duckdb.connect()
    import glob, os

    for p in glob.glob(f"{d}/*.parquet"):
        g = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{g}'")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    df = query(spark, d)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    key = lambda r: tuple((x is None, str(type(x)), x) for x in r)
    mine = sorted((tuple(r[c] for c in order) for r in df.collect()), key=key)
    other = sorted((tuple(r[names.index(c)] for c in order) for r in cur.fetchall()), key=key)
    return mine, other
