"""Run a registered query and its SQL counterpart and compare the results row by row.

    python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(root: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((v is None, str(v)) for v in r))
    return [columns[i] for i in order], out


def kind(name: str) -> str:
    name = name.lower()
    if name in ("bigint", "long", "hugeint", "int", "integer", "smallint", "tinyint", "ubigint"):
        return "whole"
    if name.startswith("decimal"):
        return "decimal"
    return {"string": "text", "varchar": "text"}.get(name, name)


def differences(spark, con, root: str, name: str, query, sql: str) -> str | None:
    df = query(spark, root)
    left_columns, left = normal(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    described = [(d[0], str(d[1])) for d in result.description]
    right_columns, right = normal([d[0] for d in described], result.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} != {right_columns}"
    spark_kinds = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    for column, t in described:
        if kind(t) != spark_kinds[column]:
            return f"type of {column}: {spark_kinds[column]} != {kind(t)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} of {len(left)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from wardmill.session import local_session

    root, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = connect(root)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or [q for q in queries if q in oracle]:
        start = time.time()
        try:
            problem = differences(spark, con, root, name, queries[name], oracle[name])
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed", failed)
