"""Compare the queries with their SQL: ``python -m murmura.llm.check SF_DIR [NAME...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from murmura.llm.oracles import ORACLES
from murmura.llm.queries import QUERIES
from murmura.session import local_session


def table(found) -> tuple[list[str], list[tuple]]:
    """Column names, and rows with the columns by name; both sorted."""
    names, rows = found
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def oracle(sf_dir: str, name: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = con.execute(ORACLES[name])
    return [c[0] for c in found.description], found.fetchall()


def difference(spark, sf_dir: str, name: str) -> str | None:
    """What differs, or None when both sides agree."""
    df = QUERIES[name](spark, sf_dir)
    names, ours = table((df.columns, [tuple(r) for r in df.collect()]))
    want_names, want = table(oracle(sf_dir, name))
    if names != want_names or len(ours) != len(want):
        return f"{names} in {len(ours)} rows, not {want_names} in {len(want)}"
    for row, other in zip(ours, want):
        if row != other:
            return f"{names}: {str(row)[:400]} instead of {str(other)[:400]}"
    return None


if __name__ == "__main__":
    session = local_session(8)
    for query in sys.argv[2:] or QUERIES:
        began = time.time()
        if query in ORACLES:
            said = difference(session, sys.argv[1], query) or "ok"
        else:
            said = f"{QUERIES[query](session, sys.argv[1]).count()} rows, no SQL"
        print(f"{query:32s} {time.time() - began:6.1f}s {said}", flush=True)
