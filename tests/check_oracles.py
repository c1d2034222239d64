"""Runs registered queries and their check SQL side by side: python -m tests.check_oracles [sf] [name …]."""

from __future__ import annotations

import math
import sys
import time
from fnmatch import fnmatch

import duckdb

import __spark_entry__ as entry
from postweave.catalog.inputs import TABLES
from postweave.session import local_session


def norm(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, sf_dir, name, query, sql):
    df = query(spark, sf_dir)
    cols, got = rows(df.columns, df.collect())
    if sql is None:
        return f"no check SQL, {len(got)} rows"
    rel = con.sql(sql)
    want_cols, want = rows(rel.columns, rel.fetchall())
    if cols != want_cols:
        return f"FAIL columns {cols} != {want_cols}"
    if got != want:
        odd = [(g, w) for g, w in zip(got, want) if g != w]
        return f"FAIL {len(got)} rows vs {len(want)}, {len(odd)} differ, first: {odd[:1]}"
    return f"ok {len(got)} rows"


def main():
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and not any(fnmatch(name, n) for n in names):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, sf_dir, name, query, oracles.get(name))
        except Exception as e:  # noqa: BLE001
            verdict = "FAIL " + f"{type(e).__name__}: {e}"[:1500]
        bad += verdict.startswith("FAIL")
        print(f"{name}: {verdict} ({time.time() - start:.1f}s)", flush=True)
    print("failed:", bad, "unmatched oracles:", sorted(set(oracles) - set(entry.queries())))


if __name__ == "__main__":
    main()
