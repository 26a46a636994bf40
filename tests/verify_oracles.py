"""Compares registered queries with their SQL in DuckDB: python tests/verify_oracles.py SF_DIR [NAME...]"""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def rows_of(frame):
    """Rows as sorted text; floats at ten digits."""

    def cell(v):
        if v is None or v != v:
            return "null"
        if isinstance(v, float):
            return f"{v:.9g}"
        return str(v)

    names = sorted(frame[0])
    at = [frame[0].index(n) for n in names]
    return names, sorted(tuple(cell(r[i]) for i in at) for r in frame[1])


def compare(spark, d, name, query, sql):
    df = query(spark, d)
    ours = rows_of((df.columns, [tuple(r) for r in df.collect()]))
    con = duckdb.connect()
    for p in glob.glob(f"{d}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    cur = con.execute(sql)
    theirs = rows_of(([c[0] for c in cur.description], cur.fetchall()))
    return ours, theirs


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    q, o = e.queries(), e.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or list(o):
        t = time.time()
        try:
            ours, theirs = compare(spark, sys.argv[1], name, q[name], o[name])
            ok = ours == theirs
            print(name, "ok" if ok else "DIFFERS", len(ours[1]), len(theirs[1]), round(time.time() - t, 1), flush=True)
            if not ok:
                bad += 1
                a, b = set(ours[1]), set(theirs[1])
                print("  ours", ours[0], list(a - b)[:3], "theirs", theirs[0], list(b - a)[:3])
        except Exception as x:
            bad += 1
            print(name, "FAILED", str(x)[:600], flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main()
