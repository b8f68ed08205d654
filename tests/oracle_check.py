"""Run queries() against oracle_sql() like the driver does (rows, schema, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, sf_dir, name, q, sql):
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    tmap = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
            "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT"}
    st = {f.name: tmap.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    dt = {d[0]: str(d[1]) for d in res.description}
    tdiff = {c: (st[c], dt.get(c)) for c in st if c in dt and st[c] != dt.get(c)}
    if tdiff:
        print(f"    types differ in {name}: {tdiff}")
    hs, ls = digest(srows, scols)
    hd, ld = digest(drows, dcols)
    ok = ok_cols and len(srows) == len(drows) and hs == hd
    print(f"{'OK ' if ok else 'BAD'} {name}: spark {len(srows)} rows {t1 - t0:.1f}s, duck {len(drows)} rows "
          f"{t2 - t1:.1f}s, cols {'same' if ok_cols else (sorted(scols), sorted(dcols))}", flush=True)
    if not ok and ok_cols:
        a, b = set(ls), set(ld)
        for x in sorted(a - b)[:3]:
            print("   spark only:", x)
        for x in sorted(b - a)[:3]:
            print("   duck  only:", x)
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from thermogrid.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = []
    for n in names or list(qs):
        if n not in os_:
            sdf = qs[n](spark, sf_dir)
            print(f"-- {n}: no oracle, {sdf.count()} rows", flush=True)
            continue
        try:
            if not compare(spark, con, sf_dir, n, qs[n], os_[n]):
                bad.append(n)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:600]}", flush=True)
            bad.append(n)
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
