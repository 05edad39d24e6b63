"""Compares query results with their SQL equivalents. Run as a script:
``python tests/oracle_check.py [folder] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(columns: list[str], rows: list) -> list[tuple]:
    """Columns sorted by name, rows sorted, floats by their exact text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in entry.oracle_sql():
        return "rows only", len(ours)
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}", len(ours)
    if ours != theirs:
        a, b = set(ours), set(theirs)
        return (f"values differ: {len(ours)} / {len(theirs)} rows; only here {sorted(a - b)[:2]};"
                f" only in SQL {sorted(b - a)[:2]}"), len(ours)
    return "match", len(ours)


if __name__ == "__main__":
    from adloom.session import build_session
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__driver__memory="8g", spark__log__level="ERROR")
    import __spark_entry__
    picked = sys.argv[2:] or list(__spark_entry__.queries())
    db = connect(folder)
    bad = 0
    for q in picked:
        begun = time.time()
        try:
            verdict, n = compare(session, db, q, folder)
        except Exception as exc:  # noqa: BLE001 - the report names every failing query
            verdict, n = f"error: {str(exc)[:1500]}", -1
        bad += verdict not in ("match", "rows only")
        print(f"{q:28} {n:8} rows {time.time() - begun:6.2f}s  {verdict}", flush=True)
    sys.exit(bool(bad))
