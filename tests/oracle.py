"""Run queries and their checking SQL side by side: python tests/oracle.py [folder] [names...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from postlake.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


def compare(spark, con, name: str, folder: str) -> str | None:
    """None when query and SQL agree, else what differs."""
    start = time.time()
    df = entry.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    print(f"{time.time() - start:5.1f}s", end=" ")
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for ours, theirs in zip(got, want):
        if ours != theirs:
            at = [i for i, (a, b) in enumerate(zip(ours, theirs)) if a != b]
            keys = sorted(names)
            return "; ".join(f"{keys[i]}: {str(ours[i])[:200]!r} against {str(theirs[i])[:200]!r}" for i in at)
    if not got:
        return "no rows"
    return None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g", spark__driver__maxResultSize="4g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception:
            problem = traceback.format_exc()[-1500:]
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
