"""Run every query next to its SQL: ``python tests/compare.py <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.queries import QUERIES, SQL  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def connect(sf_dir):
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def differences(spark, db, sf_dir, name):
    """Column names, row count and rows (as text, any order) that differ."""
    found = QUERIES[name](spark, sf_dir)
    wanted = db.sql(SQL[name])
    columns = sorted(wanted.columns)
    if sorted(found.columns) != columns:
        return [f"columns {sorted(found.columns)} instead of {columns}"]
    order = ", ".join(f'"{c}"' for c in columns)
    left = Counter(tuple(r) for r in found.select(*columns).collect())
    right = Counter(db.sql(f"SELECT {order} FROM ({SQL[name]}) q").fetchall())
    return [f"only in Spark {x}" for x in list((left - right).items())[:3]] + [
        f"only in SQL {x}" for x in list((right - left).items())[:3]
    ] + ([f"{sum(left.values())} rows"] if left != right else [])


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    wrong = 0
    for name in names:
        started = time.time()
        found = differences(spark, db, sf_dir, name)
        wrong += bool(found)
        print(f"{name:30s} {'ok' if not found else found} {time.time() - started:.1f}s", flush=True)
    sys.exit(bool(wrong))


if __name__ == "__main__":
    main()
