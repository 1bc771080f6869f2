"""Run registered queries against DuckDB on the same parquet tables and report differences.

    python -m tests.compare [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return "NULL" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark_df, sql, con):
    """(ok, message, spark rows)"""
    mine = rows_of([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if sql is None:
        return True, "rows only", len(mine)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(cur.fetchall(), names)
    if sorted(names) != sorted(spark_df.columns):
        return False, f"columns {sorted(spark_df.columns)} vs {sorted(names)}", len(mine)
    if mine == theirs:
        return True, "equal", len(mine)
    a, b = set(mine), set(theirs)
    return False, f"rows {len(mine)} vs {len(theirs)}; only spark {sorted(a - b)[:3]}; only sql {sorted(b - a)[:3]}", len(mine)


def main(argv):
    from funnelspark.session import build_session

    folder = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        folder = argv[i + 1]
        argv = argv[:i] + argv[i + 2 :]
    import __spark_entry__ as entry

    spark = build_session("compare", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle, bad = entry.oracle_sql(), []
    names = [n for n in entry.queries() if not argv or any(n.startswith(p) for p in argv)]
    for name in names:
        start = time.time()
        try:
            ok, msg, n = compare(entry.queries()[name](spark, folder), oracle.get(name), con)
        except Exception as err:
            ok, msg, n = False, f"{type(err).__name__}: {str(err)[:600]}", 0
        flag = "ok  " if ok else "FAIL"
        print(f"{flag} {name:34s} {n:7d} rows {time.time() - start:6.2f}s {'' if ok and msg == 'equal' else msg}", flush=True)
        if ok and n == 0:
            print("     EMPTY RESULT", name)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} ok; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
