"""Compare every registered query with its DuckDB oracle (rows, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, Decimal) and v == v.to_integral_value():
        return (1, str(int(v)))  # sums of integers come as decimals of scale 0
    if isinstance(v, (float, Decimal)):
        whole = math.isfinite(v) and abs(v) < 1e9 and v == int(v)
        return (1, str(int(v)) if whole else f"{v:.9g}")
    if isinstance(v, int):
        return (1, str(v))  # exact: ids, offsets and epochs have more than nine digits
    if isinstance(v, (bytes, bytearray)):
        return (1, v.decode("utf-8", "replace"))
    return (1, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], out


def duck(sf_dir, sql):
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    dt = time.time() - t0
    scols, srows = canon(df.columns, rows)
    if sql is None:
        return True, f"{name}: rows={len(rows)} (no oracle) {dt:.1f}s"
    dcols, drows = canon(*duck(sf_dir, sql))
    ok = scols == dcols and srows == drows
    msg = f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} {dt:.1f}s"
    if not ok:
        if scols != dcols:
            msg += f"\n  cols spark={scols} duck={dcols}"
        else:
            a, b = set(srows), set(drows)
            msg += f"\n  only spark: {sorted(a - b)[:3]}\n  only duck: {sorted(b - a)[:3]}"
    return ok, msg


def main():
    from pyspark.sql import SparkSession
    import tempfile
    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rivulet-oracle-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            ok, msg = compare(spark, sf_dir, name, qs[name], sqls.get(name))
        except Exception as e:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(msg, flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
