"""Run registered queries beside their SQL and compare the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return "null" if v is None else str(v)


def _kind(name: str) -> str:
    name = name.lower()
    for kind, names in {
        "int": ("tinyint", "smallint", "int", "integer"),
        "long": ("bigint", "hugeint"),
        "double": ("double", "float"),
        "text": ("string", "varchar"),
        "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if name in names:
            return kind
    return name


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return len(got) > 0, f"rows only: {len(got)}, {took:.1f}s"
    start = time.time()
    want = con.execute(sql)
    names, types = [d[0] for d in want.description], [str(d[1]) for d in want.description]
    want_rows = want.fetchall()
    took2 = time.time() - start
    note = f"{len(got)} rows, spark {took:.1f}s, sql {took2:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns {df.columns} / {names}"
    mine = {c: _kind(t) for c, t in df.dtypes}
    theirs = {c: _kind(t) for c, t in zip(names, types)}
    if mine != theirs:
        return False, f"types {mine} / {theirs}"
    a, b = rows_of(df.columns, got), rows_of(names, want_rows)
    if a != b:
        extra, lacking = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        cut = lambda rows: [[c[:150] for c in r] for r in rows]
        return False, f"{note}; sql has {len(b)}; only spark {cut(extra)}; only sql {cut(lacking)}"
    return True, note


if __name__ == "__main__":
    import __spark_entry__ as e
    from tertulia.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    session = build_session(master="local[8]", **{"spark.ui.showConsoleProgress": "false"})
    db, sqls, bad = connect(folder), e.oracle_sql(), []
    for key, run in e.queries().items():
        if len(sys.argv) > 2 and key not in sys.argv[2:]:
            continue
        try:
            ok, text = compare(session, db, folder, key, run, sqls.get(key))
        except Exception as err:  # noqa: BLE001
            ok, text = False, f"{type(err).__name__}: {str(err)[:600]}"
        print("ok  " if ok else "FAIL", key, text, flush=True)
        bad += [] if ok else [key]
    print("failed:", bad)
