"""Run registered queries and their SQL twins on the same tables and compare whole results.

``python tests/oracle.py [--sf DIR] [name or module ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(body, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    left_cols, left = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    right_cols, right = normal([d[0] for d in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}; first {left[:2]} / {right[:2]}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)}/{len(left)} rows differ, first:\n   {bad[0][0]}\n   {bad[0][1]}"
    return f"EMPTY" if not left else None


def main() -> None:
    from harborline.plans.registry import all_queries, all_sql
    from harborline.session import local_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf_dir = args[at + 1]
        del args[at : at + 2]
    spark = local_session(8)
    con = connect(sf_dir)
    sqls = all_sql()
    failed = 0
    for name, fn in all_queries().items():
        module = fn.__closure__ and next(
            (c.cell_contents.__module__ for c in fn.__closure__ if callable(c.cell_contents)), ""
        )
        if args and not any(a == name or module.endswith(a) for a in args):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                verdict = compare(df, con, sqls[name])
            else:
                n = len(df.collect())
                verdict = None if n else "EMPTY"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += verdict is not None
        tag = "ok  " if verdict is None else "FAIL"
        print(f"{tag} {name} {'' if name in sqls else '(rows only) '}{time.time() - start:.1f}s {(verdict or '')[:900]}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
