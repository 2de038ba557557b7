"""Compare every query with its SQL twin: columns, types, rows and values.

``python -m tests.compare [sf_dir] [name ...]``
"""
from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from tests.session import make_session

_SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{v + 0.0:.6f}" if isinstance(v, float) else str(v)


def _rows(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; empty if the two agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    types = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, spark_type in df.dtypes:
        if _SPARK_TYPES.get(spark_type, spark_type) != types[name]:
            found.append(f"type of {name}: {spark_type} != {types[name]}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    expected = _rows(names, expected_rows)
    if len(got) != len(expected):
        found.append(f"{len(got)} rows != {len(expected)}")
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return found


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, sqls, failed = make_session(), connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            found = differences(df, con, sqls[name]) if name in sqls else []
            note = "" if name in sqls else f"(rows only: {df.count()})"
        except Exception as e:  # report and go on with the next query
            found, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {time.perf_counter() - start:6.2f}s {name} {note}",
              *found, sep="\n     " if found else " ", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
