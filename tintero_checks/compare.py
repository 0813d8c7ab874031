"""Run queries next to their SQL in DuckDB and compare rows and types.

    python -m tintero_checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(rows, columns, names):
    order = [columns.index(n) for n in names]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return sorted((tuple(row[i] for i in order) for row in rows), key=key)


def differences(spark: SparkSession, con, query, oracle: str | None, sf_dir: str) -> list[str]:
    """What differs between the Spark result and the SQL result; empty when they agree."""
    df = query(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    if oracle is None:
        return []
    relation = con.sql(oracle)
    theirs = relation.fetchall()
    found = []
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {df.columns} / {relation.columns}"]
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    for name, kind in df.dtypes:
        if _DUCK_TYPES.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} / {types[name]}")
    a, b = _sorted(mine, df.columns, names), _sorted(theirs, relation.columns, names)
    if len(a) != len(b):
        found.append(f"rows {len(a)} / {len(b)}")
    if not a:
        found.append("empty result") if sf_dir.endswith("sf0.01") else None
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        found.append(f"values differ, e.g. {bad}")
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from tintero.session import local_session
    from tintero_checks.queries import ORACLES, QUERIES

    spark, con = local_session(8), connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = differences(spark, con, QUERIES[name], ORACLES.get(name), sf_dir)
        except Exception as problem:  # noqa: BLE001 - report and go on
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        failed += bool(found)
        state = "ok" if not found else "FAIL " + "; ".join(found)
        print(f"{name:34s} {time.time() - start:6.2f}s {state}", flush=True)
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, args) else 0)
