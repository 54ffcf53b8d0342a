"""Run registered queries next to their SQL on DuckDB.

    python -m tests.oracle_check [--sf 0.01] [--from NAME] [query ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import glob
import os
import sys
import time

import duckdb

import __spark_entry__ as contract


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cellarium-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "binary": "BLOB",
}


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty when equal, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return "" if rows else "no rows"
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    got_columns, got = _sorted(df.columns, rows)
    want_columns, want = _sorted(want_columns, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    for column, kind in df.dtypes:
        if KINDS.get(kind, kind) != want_types[column]:
            return f"type of {column}: {kind} != {want_types[column]}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lost = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} != {len(want)}; only here {extra}; only SQL {lost}"
    if not got and name != "filter_block":
        return "both empty"
    return ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--hot", type=int, help="rows that make a key hot")
    parser.add_argument("--broadcast", type=int, help="largest broadcast side, in rows")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = session(), database(sf_dir)
    if args.hot is not None:
        spark.conf.set("spark.cellarium.hotGroupRows", str(args.hot))
    if args.broadcast is not None:
        spark.conf.set("spark.cellarium.broadcastRows", str(args.broadcast))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    failed = 0
    for name in args.names or contract.queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
