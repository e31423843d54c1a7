"""Run registered queries against their oracle: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def spark_rows(df):
    return canonical(df.columns, df.collect())


def oracle_rows(con, sql):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if [(type(x), x) if isinstance(x, bool) else x for x in a] != [
            (type(x), x) if isinstance(x, bool) else x for x in b
        ] or repr(a) != repr(b) and [repr(x) for x in a] != [repr(x) for x in b]:
            return f"\n  spark  {a}\n  oracle {b}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    from tests.conftest import make_session

    spark = make_session()
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            result = spark_rows(queries[name](spark, sf_dir))
            seconds = time.time() - started
            problem = difference(result, oracle_rows(con, oracles[name])) if name in oracles else None
            note = "oracle" if name in oracles else "rows"
        except Exception as error:  # keep going: this is a report
            problem, seconds, note, result = f"{type(error).__name__}: {str(error)[:600]}", 0.0, "error", ([], [])
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {note:6s} {len(result[1]):7d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
