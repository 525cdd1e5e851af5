"""Run catalog queries in Spark and their SQL in DuckDB; compare results.

Mirrors the driver's check: same row count, same column names, and the
same multiset of rows after sorting columns by name (floats rounded).
Usable as a script: ``python tests/oracle_check.py [sf_dir] [names...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    out = [tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    dpdf = con.execute(sql).df()
    problems = []
    if sorted(spdf.columns) != sorted(dpdf.columns):
        problems.append(f"columns spark={list(spdf.columns)} duck={list(dpdf.columns)}")
    if len(spdf) != len(dpdf):
        problems.append(f"rows spark={len(spdf)} duck={len(dpdf)}")
    if not problems:
        a, b = rows_of(spdf), rows_of(dpdf)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(spdf), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from clickmart.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows (no oracle)")
            continue
        try:
            problems, n, secs = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, n, secs = [f"error {type(e).__name__}: {str(e)[:300]}"], -1, 0
        bad += bool(problems)
        print(f"{'OK  ' if not problems else 'FAIL'}  {name}: {n} rows {secs:.1f}s {'; '.join(problems)}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
