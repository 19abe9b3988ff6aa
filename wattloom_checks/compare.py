"""Run every registered query against its SQL: python -m wattloom_checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

from wattloom_checks.oracle import ORACLE
from wattloom_checks.queries import QUERIES
from wattloom.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        path = f"{sf_dir}/{file}"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{files}'")
    return connection


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def same(spark_frame, relation) -> tuple[bool, str]:
    ours = sorted_rows(spark_frame.columns, [tuple(row) for row in spark_frame.collect()])
    theirs = sorted_rows(relation.columns, relation.fetchall())
    if sorted(spark_frame.columns) != sorted(relation.columns):
        return False, f"columns {sorted(spark_frame.columns)} != {sorted(relation.columns)}"
    if ours != theirs:
        first = next((pair for pair in zip(ours, theirs) if pair[0] != pair[1]), "row counts")
        return False, f"{len(ours)} rows, SQL {len(theirs)}; first difference: {first}"
    return True, f"{len(ours)} rows"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names or QUERIES:
        started = time.perf_counter()
        try:
            equal, detail = same(QUERIES[name](spark, sf_dir), connection.sql(ORACLE[name]))
        except Exception as error:
            equal, detail = False, f"{type(error).__name__}: {str(error)[:600]}"
        failures += not equal
        print(f"{'ok  ' if equal else 'FAIL'} {name}: {detail} ({time.perf_counter() - started:.1f} s)", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
