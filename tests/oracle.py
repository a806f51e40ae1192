"""Runs a query and its SQL side by side."""

import glob
import math
import os
from collections import Counter

import duckdb


def value(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(value(r[i]) for i in order) for r in data)


def same(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    df = query(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    a, b = rows(df.columns, got), rows(names, cur.fetchall())
    assert a == b, (list((a - b))[:2], list((b - a))[:2])
    return len(got)
