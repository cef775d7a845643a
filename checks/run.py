"""Run registered queries against their SQL twins in DuckDB.

    python -m checks.run [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time

import duckdb

from checks.catalogue import CHECKS
from fieldmark import get_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def _table(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(name: str, spark, con, sf_dir: str) -> tuple[bool, str]:
    check = CHECKS[name]
    began = time.time()
    df = check.query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spent = time.time() - began
    sql = check.oracle()
    if sql is None:
        return len(rows) > 0, f"{len(rows)} rows, rows only, {spent:.1f}s"
    began = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    oracle_rows = cursor.fetchall()
    oracle_spent = time.time() - began
    got, want = _table(df.columns, rows), _table(names, oracle_rows)
    note = f"{len(rows)} rows, {spent:.1f}s (oracle {oracle_spent:.1f}s)"
    if got[0] != want[0]:
        return False, f"{note}; columns {got[0]} against {want[0]}"
    if got[1] == want[1]:
        return True, note
    extra = [r for r, w in zip(got[1], want[1]) if r != w][:2]
    missing = [w for r, w in zip(got[1], want[1]) if r != w][:2]
    wrong = sum(r != w for r, w in zip(got[1], want[1]))
    return False, f"{note}; oracle {len(oracle_rows)} rows; {wrong} differ; got {extra} want {missing}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = 0
    for name in args.names or CHECKS:
        try:
            ok, note = compare(name, spark, con, args.sf)
        except Exception as error:  # report every query, then fail
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
