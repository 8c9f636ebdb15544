"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

from sluice.sources.testdata import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    return [names[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def assert_same(df, con, sql):
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    assert sc == dc, f"columns differ: {sc} vs {dc}"
    assert len(sr) == len(dr), f"row counts differ: {len(sr)} vs {len(dr)}"
    for a, b in zip(sr, dr):
        assert a == b, f"first differing row: {a} vs {b}"
