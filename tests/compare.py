"""Run every query beside its SQL and report differences.

``python tests/compare.py SF_DIR [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(normal(row[i]) for i in order)) for row in rows)


def compare(spark, connection, sf_dir: str, function, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    got = function(spark, sf_dir)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} against {sorted(names)}"
    mine = rows_of(got.columns, got.collect())
    theirs = rows_of(names, result.fetchall())
    if mine == theirs:
        return None
    only = [r for r in mine if r not in set(theirs)][:2], [r for r in theirs if r not in set(mine)][:2]
    return f"{len(mine)} rows against {len(theirs)}; only here {only[0]}; only there {only[1]}"[:900]


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    from tablesync.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    db = connect(sf)
    for name, function in queries().items():
        if (sys.argv[2:] and name not in sys.argv[2:]) or name not in oracle_sql():
            continue
        start = time.time()
        try:
            problem = compare(spark, db, sf, function, oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if problem is None else 'DIFFERS ' + problem}", flush=True)
