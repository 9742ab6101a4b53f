"""Compare every query with its SQL: ``python -m acceptance.check SF_DIR [NAME...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from acceptance.oracles import ORACLES
from acceptance.queries import QUERIES


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def _kind(name: str) -> str:
    return {"BIGINT": "int", "HUGEINT": "int", "INTEGER": "int"}.get(name, name.lower())


def oracle(sf_dir: str, name: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    return sorted(columns), _rows(columns, found.fetchall())


def result(spark: SparkSession, sf_dir: str, name: str) -> tuple[list[str], list[tuple]]:
    df = QUERIES[name](spark, sf_dir)
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def difference(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """What differs, or None when both sides agree."""
    columns, rows = result(spark, sf_dir, name)
    want_columns, want = oracle(sf_dir, name)
    if columns != want_columns:
        return f"columns {columns} instead of {want_columns}"
    if len(rows) != len(want):
        return f"{len(rows)} rows instead of {len(want)}"
    for ours, theirs in zip(rows, want):
        if ours != theirs:
            return f"row {str(ours)[:300]} instead of {str(theirs)[:300]}"
    return None


if __name__ == "__main__":
    from murmura.session import local_session

    session = local_session(8)
    failed = 0
    for query in sys.argv[2:] or QUERIES:
        started = time.time()
        try:
            if query in ORACLES:
                problem = difference(session, sys.argv[1], query)
            else:
                problem = "no oracle"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{query:32s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    sys.exit(1 if failed else 0)
