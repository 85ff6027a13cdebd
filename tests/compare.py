"""Run registered queries against their DuckDB text: ``python tests/compare.py [sf] [name prefix ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.date()
    if hasattr(value, "as_integer_ratio"):
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(normal(r[i]) for i in order) for r in rows]


def key(row: tuple):
    return tuple((x is None, f"{x:.3f}" if isinstance(x, float) else str(x)) for x in row)


def same(a, b) -> bool:
    if type(a) is not type(b):
        return False
    if isinstance(a, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=0.0) and repr(round(a, 9)) == repr(round(b, 9))
    return a == b


def compare(con, df, sql: str) -> str:
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    names = sorted(columns)
    got.sort(key=key)
    want.sort(key=key)
    for g, w in zip(got, want):
        for name, a, b in zip(names, g, w):
            if not same(a, b):
                return f"{name}: {a!r} ({type(a).__name__}) != {b!r} ({type(b).__name__}) in {g} / {w}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from lossmetrics.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = compare(con, df, oracle[name])
                note = "ok" if not problem else "DIFF " + problem
            else:
                note = f"rows only: {len(df.collect())}"
        except Exception as exc:  # noqa: BLE001
            note = "FAIL " + str(exc)[:1500]
        bad += note.startswith(("DIFF", "FAIL"))
        print(f"{time.time() - start:6.2f}s {name}: {note}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
