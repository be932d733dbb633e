"""Run registered queries beside their oracle: `python -m checks.compare SF_DIR [KEY ...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _row_key(row: tuple) -> list:
    return [(value is not None, str(value)) for value in row]


def _rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(r[i] for i in order) for r in rows), key=_row_key)


def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list]:
    """Number of Spark rows, and the first rows that differ (none when all agree)."""
    answer = db.execute(sql)
    names = [d[0] for d in answer.description]
    want_names, want = _rows(names, answer.fetchall())
    got_names, got = _rows(result.columns, [tuple(r) for r in result.collect()])
    if got_names != want_names:
        return len(got), [("columns", got_names, want_names)]
    if len(got) != len(want):
        return len(got), [("rows", len(got), len(want))]

    def same(a: tuple, b: tuple) -> bool:
        return a == b and [type(x) for x in a] == [type(x) for x in b]

    return len(got), [(a, b) for a, b in zip(got, want) if not same(a, b)][:3]


def main(sf_dir: str, *keys: str) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    spark, db = local_session(os.environ.get("BENCH_CPUS", "8")), database(sf_dir)
    bad = 0
    for key in keys or QUERIES:
        start = time.time()
        try:
            count, diff = differences(QUERIES[key](spark, sf_dir), db, ORACLE[key])
        except Exception as error:  # report and go on with the next query
            count, diff = 0, [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(diff)
        print(f"{'DIFF' if diff else 'ok  '} {key:24s} {count:8d} rows {time.time() - start:6.2f} s", flush=True)
        for line in diff:
            print("     ", line)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
