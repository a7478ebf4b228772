"""Run registered queries and their SQL side by side: python tests/compare.py [sf_dir] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v: object) -> object:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(v) + 0.0
    return v


def _rows(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when the Spark query and the SQL return the same rows, else what differs."""
    from shelfcast.checks import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    if name not in ORACLES:
        return None if got else "no rows"
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if kinds.get(kind) != types[column]:
            return f"type of {column}: {kind} != {types[column]}"
    want = result.fetchall()
    a, b = _rows(df.columns, [tuple(r) for r in got]), _rows(names, want)
    if a != b:
        return f"rows {len(got)} vs {len(want)}; only Spark {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
    return None if got else "both are empty"


def main() -> None:
    from shelfcast.checks import ORACLES, QUERIES
    from shelfcast.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind:4} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")


if __name__ == "__main__":
    main()
