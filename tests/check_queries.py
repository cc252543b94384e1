"""Compare registered queries with their SQL: ``python tests/check_queries.py [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES.split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def normal(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, db, run, sql, sf_dir) -> tuple[int, str | None]:
    """Number of rows and, if the two sides differ, how."""
    frame = run(spark, sf_dir)
    names, mine = table(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return len(mine), None
    result = db.execute(sql)
    other_names, other = table([d[0] for d in result.description], result.fetchall())
    if names != other_names:
        return len(mine), f"columns {names} / {other_names}"
    if len(mine) != len(other):
        return len(mine), f"{len(mine)} rows / {len(other)} rows"
    for a, b in zip(mine, other):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            wrong = sum(1 for x, y in zip(mine, other) if x != y)
            return len(mine), f"{wrong} rows differ, first {a} / {b}"
    return len(mine), None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tillroll.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, db = local_session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or list(queries):
        start = time.time()
        try:
            rows, problem = difference(spark, db, queries[name], oracles.get(name), folder)
        except Exception as e:
            rows, problem = -1, f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {kind} {rows:8} {time.time() - start:6.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed, {len(set(queries) - set(oracles))} without SQL")
