"""Compare a query with its SQL: same columns, same rows in any order."""

import glob
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir=SF_DIR):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return round(v, 6) if v != int(v) else int(v)
    try:
        return int(v) if v == int(v) else v
    except (TypeError, ValueError):
        return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def assert_same(spark, con, query, sql, sf_dir=SF_DIR):
    df = query(spark, sf_dir)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert rows_of(df.columns, df.collect()) == rows_of(names, want.fetchall())
