"""Run queries in Spark and their SQL twins in DuckDB and compare the rows.

    python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from limitlens.queries.oracle import ORACLE  # noqa: E402
from limitlens.queries.registry import QUERIES  # noqa: E402
from limitlens.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


# Spark type -> the SQL types that count as the same.
_KINDS = {
    "bigint": ("BIGINT", "NUMBER"), "int": ("INTEGER", "NUMBER"), "double": ("DOUBLE", "NUMBER"),
    "string": ("VARCHAR", "STRING"), "date": ("DATE", "Date"),
    "timestamp_ntz": ("TIMESTAMP", "DATETIME"), "boolean": ("BOOLEAN", "bool"),
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    found = frame.collect()
    if name not in ORACLE:
        return None if found else "no rows"
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    odd = {c: (k, kinds[c]) for c, k in frame.dtypes if kinds[c] not in _KINDS.get(k, kinds[c])}
    if odd:
        return f"types {odd}"
    mine, theirs = _rows(frame.columns, found), _rows(columns, cursor.fetchall())
    if mine == theirs:
        return None
    extra, lost = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
    return f"{sum(mine.values())} against {sum(theirs.values())} rows; only here {extra}, only there {lost}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # the other queries still run
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
