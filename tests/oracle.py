"""Runs registered queries and their SQL side by side (also: python tests/oracle.py [sf_dir] [name ...])."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The driver's table names.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "as_tuple"):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else float(repr(v))
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; spark {got[:2]} sql {want[:2]}"
    diff = [(a, b) for a, b in zip(got, want) if a != b and not all(_same(x, y) for x, y in zip(a, b))]
    return f"{len(diff)} of {len(got)} rows differ, e.g. spark {diff[0][0]} sql {diff[0][1]}" if diff else None


def _same(x, y):
    if type(x) in (int, float) and type(y) in (int, float):
        return x == y
    return x == y and (type(x) is type(y))


def session(cores: int = 8, codegen: bool = True):
    """Without code generation tiny inputs run faster: nothing is compiled per query."""
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.codegen.wholeStage", str(codegen).lower())
        .config("spark.sql.codegen.factoryMode", "FALLBACK" if codegen else "NO_CODEGEN")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    from premisa.catalog import QUERIES, SQL

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    names = argv[1:] or list(QUERIES)
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in names:
        began = time.time()
        try:
            if name in SQL:
                problem = compare(spark, con, QUERIES[name], SQL[name], sf_dir)
                note = "ok" if problem is None else problem
            else:
                problem, note = None, f"rows only: {QUERIES[name](spark, sf_dir).count()}"
        except Exception as e:  # report and go on with the next query
            problem = note = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - began:6.1f}s  {note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
