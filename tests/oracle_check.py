"""Run registered queries in Spark and their oracle SQL in DuckDB, and
compare row count, column names and order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", float(f"{v:.10g}"))
    if isinstance(v, decimal.Decimal):
        return ("f", float(f"{float(v):.10g}"))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("t", dt.datetime(v.year, v.month, v.day).isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return ("s", str(v))


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    from tidemark.plans.catalog import QUERIES
    from tidemark.plans.oracle import ORACLE

    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    scols = sorted(sdf.columns)
    t1 = time.time()
    if name not in ORACLE:
        return True, f"{name}: rows-only {len(srows)} rows ({t1 - t0:.1f}s)"
    con = con or duck(sf_dir)
    rel = con.sql(ORACLE[name])
    dcols_raw = rel.columns
    drows = [dict(zip(dcols_raw, r)) for r in rel.fetchall()]
    dcols = sorted(dcols_raw)
    if scols != dcols:
        return False, f"{name}: columns differ spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"{name}: rows spark={len(srows)} duck={len(drows)}"
    sk = sorted(tuple(_norm(r[c]) for c in scols) for r in srows)
    dk = sorted(tuple(_norm(r[c]) for c in dcols) for r in drows)
    if sk != dk:
        for a, b in zip(sk, dk):
            if a != b:
                diff = [(c, x, y) for c, x, y in zip(scols, a, b) if x != y]
                return False, f"{name}: value mismatch first diff {diff[:4]}"
    return True, f"{name}: OK {len(srows)} rows ({t1 - t0:.1f}s spark)"


def main() -> int:
    sys.path.insert(0, ".")
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
