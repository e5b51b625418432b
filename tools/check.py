"""Run registered queries next to their SQL twins and report differences.

usage: python tools/check.py [sf] [name ...]      (names may be module:NAME to take a whole module)
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemill.plans import registry  # noqa: E402
from tidemill.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canon(value):
    """Comparable form that keeps the type class (int, float, str, ...) visible."""
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if value != value else repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(canon(v) for v in value))
    return (type(value).__name__, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(canon(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_columns, spark_rows, sql_columns, sql_rows) -> str | None:
    """None when equal, else a short description of the first difference."""
    names, left = rows_of(spark_columns, spark_rows)
    other, right = rows_of(sql_columns, sql_rows)
    if names != other:
        return f"columns {names} vs {other}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            bad = sum(x != y for x, y in zip(left, right))
            return f"{bad} rows differ, first:\n   spark {a}\n   sql   {b}"
    return None


def connect(base: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{base}/{t}.parquet')")
    return con


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    base = f"/root/testdata/sf{sf}"
    if wanted and all(w.startswith("module:") for w in wanted):
        for w in wanted:
            __import__(f"tidemill.plans.{w[7:]}")
        names = list(registry.JOBS)
    else:
        registry.load_all()
        names = wanted or list(registry.JOBS)
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.maxResultSize": "4g",
    }
    spark = build_session("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(base)
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            df = registry.runner(registry.JOBS[name])(spark, base)
            rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if name not in registry.SQL:
                print(f"rows  {name}: {len(rows)} rows {t1 - t0:.1f}s {df.columns} {rows[:1]}", flush=True)
                failed += not rows
                continue
            cur = con.execute(registry.SQL[name])
            diff = compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
            t2 = time.time()
            note = "" if rows else " EMPTY"
            print(f"{'ok   ' if diff is None else 'DIFF '} {name}: {len(rows)} rows{note} spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s"
                  + ("" if diff is None else f"\n   {diff}"), flush=True)
            failed += diff is not None or not rows
        except Exception as exc:  # report and go on with the next query
            print(f"ERROR {name}: {str(exc)[:900]}", flush=True)
            failed += 1
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
