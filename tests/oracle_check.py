"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [--plain] [sf_dir] [name ...]
(--plain: a bare SparkSession instead of the recommended conf)
Comparison: row count, column names, and the sorted multiset of rows with
columns ordered by name (exact values).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is None else "", v if v is not None else 0)
                 for v in row)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, repr(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols = df.columns
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = [tuple(r) for r in cur.fetchall()]
    res["oracle_rows"] = len(orows)
    a_cols, a = canon(scols, srows)
    b_cols, b = canon(ocols, orows)
    if a_cols != b_cols:
        res["status"] = f"COLUMNS {a_cols} vs {b_cols}"
    elif len(a) != len(b):
        res["status"] = "ROWCOUNT"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"VALUES e.g. {diff}"
    else:
        res["status"] = "ok"
    return res


def plain_session():
    """A bare session, as a caller who never saw our recommended conf builds it."""
    from pyspark.sql import SparkSession
    return (SparkSession.builder.master("local[8]").appName("plain")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", "8").getOrCreate())


def main(argv):
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tideline.plans.registry import ORACLE, QUERIES
    from tideline.session import build_session
    spark = plain_session() if plain else build_session()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        try:
            r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
