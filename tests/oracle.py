"""Runs a registered query and its SQL over the same tables and compares them as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

FOLDER = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, list | tuple):
        return tuple(plain(y) for y in x)
    return x


def compare(spark, queries, sql, name, folder=FOLDER):
    df = queries[name](spark, folder)
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    result = con.execute(sql[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    got = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    want = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall())
    assert got == want
