"""Run registered queries and their SQL side by side and compare all values.

    python tests/compare.py [sf0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from newsloom.session import local_session  # noqa: E402

ROOT = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return ("nan",)
        return round(value, 9)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


_KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER"}


def difference(spark, con, folder: str, name: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    df = entry.queries()[name](spark, folder)
    names, rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    other_names, other = _rows([d[0] for d in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    for column, kind in df.dtypes:
        if _KINDS.get(kind, kind) != described[column]:
            return f"type of {column}: {kind} / {described[column]}"
    if len(rows) != len(other):
        return f"rows {len(rows)} / {len(other)}"
    for mine, theirs in zip(rows, other):
        if mine != theirs:
            pairs = [(n, a, b) for n, a, b in zip(names, mine, theirs) if a != b]
            return f"first difference {str(pairs)[:600]} in row {str(mine)[:200]}"
    return None


def main() -> int:
    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"{ROOT}/{scale}"
    spark, con = local_session(), database(folder)
    chosen = sys.argv[2:] or list(entry.queries())
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            found = difference(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:700]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
