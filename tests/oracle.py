"""Compare queries with their SQL run by DuckDB: names, row counts and values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=repr)


def compare(spark, con, run, sql: str, folder: str) -> str | None:
    """None if both agree, else what differs."""
    frame = run(spark, folder)
    names, got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"columns {names} against {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} against {b}"
    return None


def main(folder: str, *only: str) -> int:
    from msgmart.session import local_session
    from msgmart.workloads import ORACLE, QUERIES

    spark = local_session(8)
    con = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        begun = time.time()
        try:
            if name in ORACLE:
                problem = compare(spark, con, run, ORACLE[name], folder)
            else:
                problem = None if run(spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:28s} {time.time() - begun:6.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(main(*sys.argv[1:]))
