"""Compare registered queries with their SQL in DuckDB.

    python tools/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from campusweave import catalog  # noqa: E402
from campusweave.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def compare(spark, con, name, sf):
    """(ok, message) for one query."""
    df = catalog.QUERIES[name](spark, sf)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in catalog.ORACLES:
        return None, f"{len(got[1])} rows"
    cursor = con.execute(catalog.ORACLES[name])
    want = canonical([c[0] for c in cursor.description], cursor.fetchall())
    if got == want:
        return True, f"{len(got[1])} rows"
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    extra = sorted(set(got[1]) - set(want[1]))[:3]
    missing = sorted(set(want[1]) - set(got[1]))[:3]
    return False, f"{len(got[1])} vs {len(want[1])} rows\n   {got[0]}\n   spark only: {extra}\n   sql only:   {missing}"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--of", help="only queries of this catalog module")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(), connect(args.sf)
    names = [n for n in catalog.QUERIES if not args.names or any(a in n for a in args.names)]
    if args.of:
        names = [n for n in names if catalog.QUERIES[n].__module__.endswith(args.of)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            ok, message = compare(spark, con, name, args.sf)
        except Exception:
            ok, message = False, traceback.format_exc(limit=-4)[-1500:]
        bad += ok is False
        label = {True: "ok", False: "FAIL", None: "rows only"}[ok]
        print(f"{label:9} {name} ({time.time() - start:.1f}s) {message}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
