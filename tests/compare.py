"""Run a registered query in Spark and its oracle in DuckDB; compare results.

Usage: python tests/compare.py [--exact] [sf_dir] [key ...]
Mirrors the driver's check: row count, column names/types, and an
order-insensitive comparison of values (columns sorted by name). Doubles are
compared at 6 decimals, or bit for bit with ``--exact``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = False


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT",
    "tinyint": "TINYINT",
}


def type_mismatches(schema, con, sql):
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    dtypes = {d[0]: d[1] for d in desc}
    bad = []
    for f in schema.fields:
        st = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(st, st.upper())
        got = dtypes.get(f.name)
        if got is not None and got != want and not (st.startswith("array") and got.endswith("[]")):
            bad.append((f.name, st, got))
    return bad


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols = df.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    tbad = type_mismatches(df.schema, con, sql) if ok_cols else []
    ok = ok_cols and a == b and not tbad
    msg = f"{key:32s} spark={len(srows):6d} duck={len(drows):6d} " \
          f"{'OK ' if ok else 'BAD'} {t1 - t0:5.2f}s"
    if not ok_cols:
        msg += f"\n   cols spark={scols} duck={dcols}"
    elif tbad:
        msg += f"\n   types {tbad}"
    elif not ok:
        diff_a = [r for r in a if r not in b][:3]
        diff_b = [r for r in b if r not in a][:3]
        msg += f"\n   spark-only {diff_a}\n   duck-only  {diff_b}"
    return ok, msg, df.schema, res.description


def main(argv):
    global EXACT
    if "--exact" in argv:
        EXACT = True
        argv = [a for a in argv if a != "--exact"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from souk.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        if key not in oracle:
            df = qs[key](spark, sf_dir)
            print(f"{key:32s} rows-only {df.count()}")
            continue
        ok, msg, _, _ = compare(spark, con, key, qs[key], oracle[key], sf_dir)
        bad += not ok
        print(msg, flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
