"""Runs a query and its SQL over the same tables and compares their rows as multisets."""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 4)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def connect(folder):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def compare(spark, folder, query, sql):
    df = query(spark, folder)
    names = sorted(df.columns)
    ours = Counter(repr(tuple(plain(r[c]) for c in names)) for r in df.collect())
    result = connect(folder).sql(sql)
    columns = result.columns
    assert sorted(columns) == names
    theirs = Counter(repr(tuple(plain(r[columns.index(c)]) for c in names)) for r in result.fetchall())
    assert ours == theirs, (list((ours - theirs).items())[:3], list((theirs - ours).items())[:3])
