"""Compares a query with its DuckDB SQL."""

from __future__ import annotations

import glob
import os

import duckdb

from tidewatch.llm import queries


def same_as_sql(spark, sf_dir: str, name: str) -> None:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{files}'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r[c] for c in want.columns) for r in got.collect()]
    assert len(rows) > 0
    assert sorted(rows) == sorted(want.fetchall())
