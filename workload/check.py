"""Compare every query with its SQL: ``python -m workload.check [folder] [name prefix ...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

from terrasift.session import local_session
from workload import catalogue
from workload.inputs import BASE


def _cell(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, db, folder, name):
    start = time.time()
    df = catalogue.QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in catalogue.ORACLES:
        return "rows", len(got), took, ""
    start = time.time()
    cursor = db.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    duck_took = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return "COLUMNS", len(got), took, f"{sorted(df.columns)} / {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a != b:
        only_a = [r for r in a if r not in b][:3] if len(a) < 20000 else a[:2]
        only_b = [r for r in b if r not in a][:3] if len(b) < 20000 else b[:2]
        return "DIFF", len(got), took, f"{len(got)} / {len(want)} rows\n   spark {only_a}\n   sql   {only_b}"
    return "ok" if got else "EMPTY", len(got), took, f"sql {duck_took:.2f}"


def main(argv):
    folder = argv[0] if argv else "/root/testdata/sf0.001"
    prefixes = tuple(argv[1:])
    spark = local_session(8)
    db = duckdb.connect()
    for t in BASE:
        db.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    bad = 0
    for name in catalogue.QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            status, n, took, note = compare(spark, db, folder, name)
        except Exception as exc:  # noqa: BLE001 - report and go on
            status, n, took, note = "ERROR", 0, 0.0, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += status not in ("ok", "rows")
        print(f"{status:8} {name:45} {n:8} rows {took:6.2f}s {note if status != 'rows' else ''}", flush=True)
    print(f"{bad} not ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
