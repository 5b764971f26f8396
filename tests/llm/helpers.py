"""Reading the small tables and comparing with the plain versions."""

import os

import pyarrow.parquet as pq

SF = os.environ.get("TICKROLL_TEST_SF", "/root/testdata/sf0.01")


def rows(name, *columns, sf=SF):
    t = pq.read_table(f"{sf}/{name}.parquet", columns=list(columns))
    return list(zip(*(t[c].to_pylist() for c in columns)))


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def same(df, columns, want):
    assert collected(df, *columns) == sorted(want, key=repr)
