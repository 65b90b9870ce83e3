"""Differential check: every registered query vs its DuckDB SQL twin.

Usage: python tests/oracle_diff.py [sf_dir] [name ...]
Compares column names (sorted), row counts and the multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("ORACLE_EXACT") else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir: str, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(s_rows))
            if verbose:
                print(f"{name:34s} rows-only {len(s_rows)} rows  spark {t1 - t0:.1f}s", flush=True)
            continue
        rel = con.execute(sqls[name])
        d_cols = [c[0] for c in rel.description]
        d_rows = rel.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_n = len(s_rows) == len(d_rows)
        ok_v = ok_cols and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
        results[name] = (ok_cols and ok_n and ok_v, len(s_rows), len(d_rows))
        if verbose:
            flag = "OK " if results[name][0] else "BAD"
            print(f"{name:34s} {flag} spark={len(s_rows)} duck={len(d_rows)} cols={ok_cols} vals={ok_v} "
                  f"spark {t1 - t0:.1f}s", flush=True)
            if not results[name][0]:
                print("   spark cols", s_cols, "\n   duck  cols", d_cols)
                a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
                diff = [x for x in a if x not in b][:3]
                diff2 = [x for x in b if x not in a][:3]
                print("   spark-only", diff, "\n   duck-only ", diff2)
    return results


if __name__ == "__main__":
    from carbonledger.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] is False]
    print("BAD:", bad)
