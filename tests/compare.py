"""Runs registered queries on Spark and their checks on DuckDB and compares the rows.

    python tests/compare.py [--sf 0.01] [--time] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0 if value else 0.0)
    return repr(value)


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(normal(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in cur.fetchall())


def compare(spark, con, folder: str, name: str, queries, checks) -> str | None:
    """None when equal, else what differs."""
    names, rows = spark_rows(queries[name](spark, folder))
    if name not in checks:
        return None if rows else "no rows"
    names2, rows2 = duck_rows(con, checks[name])
    if names != names2:
        return f"columns {set(names) ^ set(names2)}"
    if rows == rows2:
        return None if rows else "both empty"
    extra, missing = rows - rows2, rows2 - rows
    lines = [f"rows {sum(rows.values())} / {sum(rows2.values())}, differing {sum(extra.values())} / {sum(missing.values())}", str(names)]
    lines += ["spark  " + str(r) for r in sorted(extra)[:3]] + ["check  " + str(r) for r in sorted(missing)[:3]]
    return "\n    ".join(lines)


if __name__ == "__main__":
    import __spark_entry__ as entry

    from transferlens.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8, "compare")
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{args.sf}"
    con, queries, checks = duck(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, queries, checks)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s" + (f"\n    {problem}" if problem else "") + ("" if name in checks else "  (rows only)"), flush=True)
    print(f"{bad} bad")
    spark.stop()
    sys.exit(bool(bad))
