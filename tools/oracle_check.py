"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]

Comparison: same column names (sorted), same row count, same multiset of rows
after sorting; doubles compared exactly (as the driver hashes values) and, if
that fails, within 1e-9 relative to tell rounding noise from real errors.
"""

from __future__ import annotations

import math
import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from stationflow.plans.catalog import load_all  # noqa: E402
from stationflow.session import build_session  # noqa: E402
from stationflow.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        # NaN and a negative zero are kept distinct: a hash of the values would see them
        if math.isnan(v):
            return (5, "nan")
        if v == 0.0 and math.copysign(1.0, v) < 0:
            return (5, "-0.0")
        return (1, v)
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (3, tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return (3, tuple(sorted((k, norm(x)) for k, x in v.items())))
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, int):
        return (1, float(v))
    if hasattr(v, "__float__") and not isinstance(v, str):
        return (1, float(v))
    return (4, str(v))


def close(a, b):
    if a == b:
        return True
    if a[0] == 1 and b[0] == 1:
        return abs(a[1] - b[1]) <= 1e-9 * max(1.0, abs(a[1]), abs(b[1]))
    if a[0] == 3 and b[0] == 3 and len(a[1]) == len(b[1]):
        return all(close(x, y) for x, y in zip(a[1], b[1]))
    return False


def compare(sp_rows, sp_cols, dk_rows, dk_cols):
    if sorted(sp_cols) != sorted(dk_cols):
        return f"columns differ: spark={sorted(sp_cols)} duck={sorted(dk_cols)}"
    if len(sp_rows) != len(dk_rows):
        return f"rows differ: spark={len(sp_rows)} duck={len(dk_rows)}"
    order = sorted(sp_cols)
    si = [sp_cols.index(c) for c in order]
    di = [dk_cols.index(c) for c in order]
    a = sorted(tuple(norm(r[i]) for i in si) for r in sp_rows)
    b = sorted(tuple(norm(r[i]) for i in di) for r in dk_rows)
    if a == b:
        return None
    bad = [(x, y) for x, y in zip(a, b) if not all(close(p, q) for p, q in zip(x, y))]
    if not bad:
        return "ok-approx"
    return f"values differ ({len(bad)} rows), first: spark={bad[0][0]} duck={bad[0][1]}"


SPARK2DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
              "StringType": "VARCHAR", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP",
              "BooleanType": "BOOLEAN", "FloatType": "FLOAT", "ShortType": "SMALLINT",
              "ByteType": "TINYINT", "TimestampType": "TIMESTAMP WITH TIME ZONE"}


def type_diff(schema, dk_cols, dk_types):
    out = []
    for f in schema.fields:
        st = type(f.dataType).__name__
        want = SPARK2DUCK.get(st)
        if want is None or f.name not in dk_cols:
            continue
        got = str(dk_types[dk_cols.index(f.name)])
        if got.upper() != want:
            out.append(f"{f.name}: spark {want} duck {got}")
    return "; ".join(out)


HEAP = bool(int(__import__("os").environ.get("ORACLE_HEAP", "0")))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    reg = load_all()
    n_ok = n_bad = 0
    for name, q in reg.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            sp_cols = df.columns
            sp_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-FAIL {name}: {type(e).__name__}: {str(e)[:400]}")
            traceback.print_exc(limit=3)
            n_bad += 1
            continue
        t1 = time.time()
        if q.sql is None:
            print(f"rows-only  {name}: {len(sp_rows)} rows  {t1 - t0:.1f}s")
            n_ok += 1
            continue
        try:
            res = con.execute(q.sql)
            dk_cols = [d[0] for d in res.description]
            dk_rows = res.fetchall()
            t2 = time.time()
        except Exception as e:  # noqa: BLE001
            print(f"DUCK-FAIL  {name}: {str(e)[:400]}")
            n_bad += 1
            continue
        msg = compare(sp_rows, sp_cols, dk_rows, dk_cols)
        tmsg = type_diff(df.schema, dk_cols, [d[1] for d in res.description])
        if tmsg:
            print(f"TYPES      {name}: {tmsg}")
        if msg is None:
            n_ok += 1
            print(f"ok         {name}: {len(sp_rows)} rows  spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s")
        else:
            if msg != "ok-approx":
                n_bad += 1
            else:
                n_ok += 1
            print(f"{'APPROX' if msg == 'ok-approx' else 'MISMATCH':10} {name}: {msg[:600]}")
        if HEAP:
            rt = spark._jvm.java.lang.Runtime.getRuntime()
            spark._jvm.java.lang.System.gc()
            print(f"heap       {name}: {(rt.totalMemory() - rt.freeMemory()) / 2**20:.0f} MB", flush=True)
    print(f"summary: ok={n_ok} bad={n_bad}")
    spark.stop()


if __name__ == "__main__":
    main()
