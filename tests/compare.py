"""Runs a query's DuckDB counterpart and compares the rows, in any order."""

import glob
import os

import duckdb


def tables(folder):
    c = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f if os.path.isfile(f) else f + '/*.parquet'}'")
    return c


def same(spark_df, sql, folder):
    """The rows, as dictionaries."""
    columns = sorted(spark_df.columns)
    got = [tuple(r) for r in spark_df.select(columns).collect()]
    rows = tables(folder).execute(sql)
    names = [d[0] for d in rows.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in rows.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return [dict(zip(columns, r, strict=True)) for r in got]
