"""Compare a query's rows with its SQL in DuckDB."""

import glob
import math
import os

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def _cell(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def assert_same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(sf_dir).execute(sql)
    want = normal([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
