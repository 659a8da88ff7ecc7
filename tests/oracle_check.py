"""Compare every registered query with its DuckDB oracle (as the driver does).

Usage: python tests/oracle_check.py [--pandas] [sf_dir] [name ...]
(--pandas compares through toPandas()/DuckDB .df() with every cell as text.)
Prints one line per query: row counts, column names, and whether the
multisets of rows are equal; exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def pandas_bag(pdf) -> Counter:
    """Naive client-side form: pandas frame, columns by name, every cell as str."""
    pdf = pdf[sorted(pdf.columns)]
    return Counter(map(tuple, pdf.astype(str).values.tolist()))


def main(argv: list[str]) -> int:
    use_pandas = "--pandas" in argv
    argv = [a for a in argv if a != "--pandas"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from ledgerloom.config import build_session
    spark = build_session()
    queries, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in queries.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t
        if name not in oracle:
            print(f"{name:28s} rows={len(s_rows)} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(oracle[name])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as e:
            print(f"{name:28s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        if use_pandas:
            same_rows = same_cols and pandas_bag(df.toPandas()) == pandas_bag(con.execute(oracle[name]).df())
        else:
            same_rows = same_cols and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
        ok = same_cols and same_rows and len(s_rows) == len(d_rows)
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} spark={len(s_rows)} duck={len(d_rows)} "
              f"cols={'same' if same_cols else (sorted(s_cols), sorted(d_cols))} {ts:.1f}s")
        if not ok and same_cols and not use_pandas:
            a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            print("   spark-only:", list((a - b).items())[:3])
            print("   duck-only: ", list((b - a).items())[:3])
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
