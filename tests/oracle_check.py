"""Run registered queries next to their oracle SQL and compare whole results.

Usage: python tests/oracle_check.py SF_DIR [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def session():
    import tempfile

    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="genespark-tests-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir):
    from genespark.plans.views import BASE

    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"f{v + 0.0!r}"
    return f"{type(v).__name__[0]}{v}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    start = time.time()
    df = fn(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return len(got[1]), took, None
    cur = con.execute(sql)
    want = normal([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return len(got[1]), took, f"columns {got[0]} vs {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        missing = [r for r in want[1] if r not in set(got[1])][:3]
        return len(got[1]), took, f"rows {len(got[1])} vs {len(want[1])}; extra {extra}; missing {missing}"
    return len(got[1]), took, None


def main(argv):
    import __spark_entry__ as entry

    sf_dir, prefixes = argv[0], argv[1:]
    spark, con = session(), duck(argv[0])
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            n, took, problem = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as e:  # report and go on with the next query
            n, took, problem = 0, 0.0, f"{type(e).__name__}: {str(e)[:600]}"
        mark = "FAIL" if problem else ("ok  " if name in oracles else "rows")
        bad += bool(problem)
        print(f"{mark} {name:40s} {n:8d} rows {took:6.2f}s {problem or ''}{' EMPTY' if n == 0 else ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
