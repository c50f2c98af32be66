"""Run registered queries against their SQL in DuckDB on the same Parquet files.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v if v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, fn, sql):
    """None if equal, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    got_cols, got = _rows(df.columns, df.collect())
    rel = con.execute(sql)
    want_cols, want = _rows([c[0] for c in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry
    from voxloom.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark, con = local_session(cores="8"), duck(sf_dir)
    sqls, failed = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, fn, sqls[name])
            else:
                problem = None if fn(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name}"
              + (f"  {problem}" if problem else ""), flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
