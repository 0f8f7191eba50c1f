"""Run every query beside its SQL and compare the rows.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime
import sys
import tempfile
import time
from collections import Counter

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from tideline import build_session, drop_scratch

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def plain(value: object) -> object:
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": f"{tempfile.gettempdir()}/tideline-compare",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    bad = 0
    for name in names or list(QUERIES):
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        except Exception as error:  # the other queries are still worth a look
            print(f"{name:22s} FAILED {str(error)[:1500]}")
            bad += 1
            continue
        took = time.time() - began
        if name not in ORACLES:
            print(f"{name:22s} {took:6.2f}s rows {sum(got.values())}, no SQL")
            continue
        answer = database.execute(ORACLES[name])
        columns = [c[0] for c in answer.description]
        types = dict(zip(columns, [str(c[1]) for c in answer.description]))
        want = rows_of(columns, answer.fetchall())
        same = got == want and sorted(columns) == sorted(df.columns)
        bad += not same
        print(f"{name:22s} {took:6.2f}s rows {sum(got.values())} {'ok' if same else 'DIFFERS'}")
        if not same:
            print("   spark", sorted(df.dtypes), "\n   sql  ", sorted(types.items()))
            print("   only spark", list((got - want).items())[:3])
            print("   only sql  ", list((want - got).items())[:3])
        elif "-v" in sys.argv:
            print("   ", sorted(df.dtypes), sorted(types.items()))
    drop_scratch(spark)
    return bad


if __name__ == "__main__":
    arguments = [a for a in sys.argv[1:] if not a.startswith("-")]
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, arguments[1:]) else 0)
