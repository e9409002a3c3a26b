"""Run the checked queries in Spark and DuckDB on one folder and compare them value by value.

    python tools/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import tempfile
import time
import traceback
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardmill.checks.registry import load_all  # noqa: E402
from wardmill.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def sort_key(row):
    return tuple((v is None, str(type(v)), repr(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=sort_key)


def difference(left, right):
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return f"columns differ: {set(lc) ^ set(rc)}"
    if len(lr) != len(rr):
        return f"row counts differ: spark {len(lr)}, duckdb {len(rr)}"
    bad = [(a, b) for a, b in zip(lr, rr) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(lc, a, b) if x != y]
        return f"{len(bad)} rows differ, e.g. {cells[:4]} in {a[:6]}"
    types = [(n, type(x).__name__, type(y).__name__) for a, b in zip(lr, rr) for n, x, y in zip(lc, a, b)
             if x is not None and y is not None and type(x) is not type(y)]
    return f"types differ: {types[0]}" if types else None


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, "12g", {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="wardmill-compare-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failures = 0
    for name, check in load_all().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = check(spark, folder)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if check.sql is None:
                problem = None if got[1] else "no rows"
            else:
                cur = con.execute(check.sql)
                want = rows_of([d[0] for d in cur.description], cur.fetchall())
                problem = difference(got, want)
        except Exception as e:  # noqa: BLE001
            took, got = time.time() - start, ([], [])
            problem = "".join(traceback.format_exception_only(e))[:600]
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {len(got[1]):8d} rows {took:6.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main())
