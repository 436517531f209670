"""Local twin of the driver's correctness gate.

Runs a ``queries()`` entry on Spark and its ``oracle_sql()`` twin on DuckDB
over the same parquet directory and compares row count, column names and an
order-insensitive hash of the (rounded) values.

    python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 4) + 0.0
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, sf_dir, name, qfn, sql, verbose=True):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    scols = [c.lower() for c in sdf.columns]
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    rel = con.execute(sql)
    dcols = [d[0].lower() for d in rel.description]
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"SCHEMA {sorted(scols)} vs {sorted(dcols)}"
        return res
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    if hs == hd:
        res["status"] = "OK"
    else:
        res["status"] = "VALUES"
        if verbose:
            a, b = set(ls), set(ld)
            res["only_spark"] = sorted(a - b)[:3]
            res["only_duck"] = sorted(b - a)[:3]
    return res


def main():
    import __spark_entry__ as E
    from tessera.config import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            res = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            res = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if res["status"] not in ("OK", "no-oracle"):
            bad += 1
        print(res, flush=True)
    print(f"bad={bad}")


if __name__ == "__main__":
    main()
