"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares column names, row counts and the order-insensitive multiset of
rows (exact values).  Prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import numpy as np
        if isinstance(v, np.ndarray):
            return tuple(_norm(x) for x in v.tolist())
        if isinstance(v, np.generic):
            v = v.item()
    except ImportError:
        pass
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return str(v)
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, str) and pd.isna(v)):
            return None
    except (TypeError, ValueError):
        pass
    return v


def rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(out, key=repr)


def compare(sdf, odf):
    scols, srows = rows(sdf)
    ocols, orows = rows(odf)
    if scols != ocols:
        return f"columns differ: spark={scols} oracle={ocols}"
    if len(srows) != len(orows):
        return f"row count differs: spark={len(srows)} oracle={len(orows)}"
    bad = [(a, b) for a, b in zip(srows, orows) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    return None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from murmur.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            failed += 1
            continue
        t1 = time.time()
        sql = sqls.get(name)
        if sql is None:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) spark {t1 - t0:.2f}s")
            continue
        try:
            odf = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: oracle error {type(e).__name__}: {str(e)[:400]}")
            failed += 1
            continue
        msg = compare(sdf, odf)
        if msg:
            failed += 1
            print(f"FAIL {name}: {msg}")
        else:
            print(f"OK   {name}: {len(sdf)} rows spark {t1 - t0:.2f}s")
    print(f"failed={failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
