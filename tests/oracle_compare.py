"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare results.

Usage: ``python tests/oracle_compare.py [--exact] [sf_dir] [name ...]`` — one line per query.
Values are normalised (decimals and floats to 9 significant digits, or exactly with
``--exact``; times to ISO text), columns sorted by name, rows sorted, then compared.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


EXACT = False  # --exact: compare doubles bit for bit (repr) instead of to 9 significant digits


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v) if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v) if EXACT else float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


def duck_conn(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, osql = queries(), oracle_sql()
    con = duck_conn(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in osql:
            results[name] = ("rows-only", len(srows), None)
            if verbose:
                print(f"{name:32s} rows-only  spark={len(srows)} ({t1 - t0:.1f}s)", flush=True)
            continue
        rel = con.sql(osql[name])
        ocols = [c for c in rel.columns]
        orows = rel.fetchall()
        s_sorted, s_c = rows_of(scols, srows)
        o_sorted, o_c = rows_of(ocols, orows)
        ok = s_c == o_c and s_sorted == o_sorted
        results[name] = ("ok" if ok else "MISMATCH", len(srows), len(orows))
        if verbose:
            print(f"{name:32s} {'ok' if ok else 'MISMATCH':9s} spark={len(srows)} oracle={len(orows)} "
                  f"({t1 - t0:.1f}s)", flush=True)
            if not ok:
                if s_c != o_c:
                    print("   columns spark :", s_c, "\n   columns oracle:", o_c)
                else:
                    sset, oset = set(s_sorted), set(o_sorted)
                    print("   only spark :", list(sset - oset)[:3])
                    print("   only oracle:", list(oset - sset)[:3])
    return results


if __name__ == "__main__":
    from tierline.session import get_spark
    args = [a for a in sys.argv[1:] if a != "--exact"]
    EXACT = "--exact" in sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or None
    spark = get_spark("local[8]", 8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
