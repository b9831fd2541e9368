"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object:
            df[c] = df[c].map(lambda v: repr(v) if isinstance(v, (list, dict, tuple)) else v)
    try:
        df = df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)
    except TypeError:
        df = df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)
    return df


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
                 "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint"}


def type_mismatches(spark_dtypes: dict, con, sql: str) -> list:
    rel = con.sql(sql)
    out = []
    for name, t in zip(rel.columns, rel.types):
        st = DUCK_TO_SPARK.get(str(t), str(t))
        if spark_dtypes.get(name) != st:
            out.append((name, spark_dtypes.get(name), str(t)))
    return out


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = _norm(spark_pdf), _norm(duck_pdf)
    for c in a.columns:
        x, y = a[c], b[c]
        eq = (x.astype(object).where(x.notna(), None).tolist()
              == y.astype(object).where(y.notna(), None).tolist())
        if not eq:
            bad = [(i, p, q) for i, (p, q) in enumerate(zip(x.tolist(), y.tolist()))
                   if not (p == q or (pd.isna(p) and pd.isna(q)))]
            if bad:
                return f"column {c!r}: {len(bad)} diffs, first {bad[:3]}"
    return None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tidewatch.session import build_session
    import __spark_entry__ as E

    spark = build_session()
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:800]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: {len(spdf)} rows ({ts:.1f}s) cols={list(spdf.columns)}")
            continue
        try:
            dpdf = con.execute(oracle[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:800]}")
            bad += 1
            continue
        err = compare(spdf, dpdf)
        stypes = dict(sdf.dtypes)
        tm = type_mismatches(stypes, con, oracle[name])
        if tm and not err:
            err = f"type mismatch {tm}"
        if err:
            bad += 1
            print(f"FAIL {name}: {err}")
        else:
            print(f"OK   {name}: {len(spdf)} rows ({ts:.1f}s) {stypes}")
    print(f"{bad} failing")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
