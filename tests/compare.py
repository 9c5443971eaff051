"""Row-by-row comparison of a query with its SQL counterpart."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _key(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "inf" if math.isinf(v) else repr(v)
    return str(v)


def rows_of(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(_key(v) for v in r) for r in df.select(*columns).collect())


def oracle_rows(con, sql):
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    return [rel.columns[i] for i in order], sorted(tuple(_key(r[i]) for i in order) for r in rel.fetchall())
