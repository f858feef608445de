"""Compare queries with their SQL in DuckDB: python tests/check_oracles.py <sf dir> [names…]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from siteplan.fixtures import TABLES
from siteplan.queries import ORACLES, QUERIES


def norm(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def compare(spark, sf, name, con):
    frame = QUERIES[name](spark, sf)
    got = frame.collect()
    if name not in ORACLES:
        return f"rows only: {len(got)}"
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"BAD columns {sorted(frame.columns)} != {sorted(columns)}"
    order = sorted(columns)
    a = sorted(tuple(norm(r[c]) for c in order) for r in got)
    b = sorted(tuple(norm(r[columns.index(c)]) for c in order) for r in want)
    if a == b:
        return f"ok {len(a)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"BAD {len(a)} rows against {len(b)}, {len(bad)} differ, first {bad[:1]}"


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


if __name__ == "__main__":
    from siteplan.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    con = connect(sf)
    for name in names:
        start = time.time()
        try:
            result = compare(spark, sf, name, con)
        except Exception as error:  # report and go on
            result = f"BAD {type(error).__name__}: {str(error)[:600]}"
        print(f"{name}: {result} ({time.time() - start:.1f}s)", flush=True)
    spark.stop()
