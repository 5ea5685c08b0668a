"""Run registered queries and their SQL twins and compare rows, types and values.

    python tools/compare.py --sf 0.01 [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scorewright.plans import catalogue  # noqa: E402
from scorewright.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return repr(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(name: str, spark, con, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = catalogue.QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    took = time.time() - start
    if name not in catalogue.SQL:
        return len(rows) > 0, f"rows only: {len(rows)} rows, {took:.1f}s"
    result = con.execute(catalogue.SQL[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    bad_types = {
        n: (t, kinds.get(n)) for n, t in df.dtypes if TYPES.get(t, t) != kinds.get(n)
    }
    left, right = canonical(df.columns, rows), canonical(names, expected)
    note = f"{len(rows)} rows, {took:.1f}s"
    if left[0] != right[0]:
        return False, f"columns differ: {left[0]} / {right[0]}"
    if bad_types:
        note += f", TYPES {bad_types}"
    if left[1] != right[1]:
        pairs = [(a, b) for a, b in zip(left[1], right[1]) if a != b][:2]
        return False, f"values differ ({len(rows)}/{len(expected)} rows): {left[0]} {pairs}"
    return not bad_types and len(rows) > 0, note


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), connect(sf_dir)
    failed = []
    for name in args.names or catalogue.QUERIES:
        try:
            good, note = compare(name, spark, con, sf_dir)
        except Exception as error:  # report and go on to the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        print(("ok   " if good else "FAIL ") + name, note, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
