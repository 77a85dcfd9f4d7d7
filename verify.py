"""Run registered queries and compare each with its SQL in DuckDB.

    python verify.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import time

import duckdb

from marketlake.registry import ORACLES, QUERIES
from marketlake.session import build_session


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, (int, float)):
        return (2, round(float(value), 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return (4, tuple(_cell(v) for v in value))
    return (3, str(value))


def normal_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, name):
    """(ok, message) of one query."""
    start = time.time()
    df = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return True, f"rows only: {len(rows)}, {took:.1f}s"
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = normal_rows(df.columns, rows), normal_rows(names, expected)
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
             "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}
    odd = [f"{n}: {t} / {types[n]}" for n, t in df.dtypes if kinds.get(types[n], t) != t]
    note = f"{len(rows)} rows, {took:.1f}s" + (f" TYPES {odd}" if odd else "")
    if got != want:
        left, right = set(got), set(want)
        return False, (f"{note}; differ {len(left - right)}/{len(right - left)}\n   spark {sorted(left - right)[:2]}"
                       f"\n   sql   {sorted(right - left)[:2]}")
    return not odd, note


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("verify", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    chosen = [n for n in QUERIES if not args.names or any(n.startswith(p) for p in args.names)]
    bad = []
    for name in chosen:
        try:
            ok, note = compare(spark, con, args.sf, name)
        except Exception as error:  # a failing query must not hide the others
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(("ok   " if ok else "FAIL ") + name + "  " + note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(chosen) - len(bad)} of {len(chosen)} ok; failed: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
