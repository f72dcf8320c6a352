"""Runs registered queries against their SQL twins and compares values.

Usage: python tests/check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def sql_engine(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[bool, str]:
    """Whether both give the same columns and the same bag of values."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    right = _rows(names, expected.fetchall())
    if left == right:
        return True, f"{len(left)} rows"
    only_left = [r for r in left if r not in set(right)][:2]
    only_right = [r for r in right if r not in set(left)][:2]
    return False, f"{len(left)} against {len(right)} rows; {only_left} / {only_right}"


def main(argv):
    import __spark_entry__ as entry
    from wickwork.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = sql_engine(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            if name in oracle:
                ok, note = compare(queries[name](spark, folder), con, oracle[name])
            else:
                ok, note = True, f"rows only: {queries[name](spark, folder).count()}"
        except Exception as error:  # noqa: BLE001
            ok, note = False, str(error)[:1500]
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
