"""Compare a query with its SQL counterpart, value by value, in any row order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return ("num", format(value.normalize(), "f"))
    if isinstance(value, (int, float)):
        if isinstance(value, float):
            if math.isnan(value):
                return ("num", "nan")
            if value == int(value) if math.isfinite(value) else False:
                return ("num", str(int(value)))
        return ("num", repr(value))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def multiset(rows, columns, order):
    at = [columns.index(c) for c in order]
    return Counter(tuple(plain(row[i]) for i in at) for row in rows)


def differences(frame, con, sql: str) -> list[str]:
    """Empty when both sides hold the same columns and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    got = [tuple(r) for r in frame.collect()]
    if len(got) != len(expected):
        problems.append(f"{len(got)} rows != {len(expected)}")
    order = sorted(names)
    ours = multiset(got, frame.columns, order)
    theirs = multiset(expected, names, order)
    if ours != theirs:
        problems.append(f"only ours: {list((ours - theirs).items())[:3]}")
        problems.append(f"only theirs: {list((theirs - ours).items())[:3]}")
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    for name, kind in frame.dtypes:
        want = TYPES.get(kind.split("(")[0].split("<")[0])
        if want and not kinds[name].startswith(want):
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    return problems


TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal": "DECIMAL",
    "timestamp": "TIMESTAMP",
}
