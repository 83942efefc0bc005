"""Compare registered queries with their DuckDB counterparts: python tests/oracle_check.py [sf] [name...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata"


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _kind(dtype) -> str:
    if pd.api.types.is_bool_dtype(dtype):
        return "bool"
    if pd.api.types.is_integer_dtype(dtype):
        return "int"
    if pd.api.types.is_float_dtype(dtype):
        return "float"
    return "other"


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    text = df.apply(lambda s: s.map(lambda v: "~" if v is None or v is pd.NA or (isinstance(v, float) and v != v) else (f"{v:.9g}" if isinstance(v, float) else str(v))))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def compare(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    """None when equal, else a short description."""
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} vs {len(duck_df)}"
    kinds = {c: (_kind(spark_df[c].dtype), _kind(duck_df[c].dtype)) for c in spark_df.columns}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and not spark_df[c].isna().any() and len(spark_df)}
    if odd:
        return f"types {odd}"
    a, b = _canon(spark_df), _canon(duck_df)
    if not a.equals(b):
        where = (a != b).any(axis=1)
        cols = [c for c in a.columns if (a[c] != b[c]).any()]
        return f"{int(where.sum())} of {len(a)} rows differ in {cols}\n{a[where].head(3).to_string()}\n{b[where].head(3).to_string()}"
    return None


def main() -> None:
    import __spark_entry__ as e
    from wayspan.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf), e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            got = fn(spark, f"{DATA}/{sf}").toPandas()
            took = time.time() - start
            verdict = compare(got, con.execute(sqls[name]).df()) if name in sqls else "rows-only"
        except Exception as exc:  # report and go on with the next query
            got, took, verdict = [], time.time() - start, f"ERROR {type(exc).__name__}: {str(exc)[:1500]}"
        ok = verdict in (None, "rows-only")
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name} rows={len(got)} {took:.1f}s {verdict or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
