"""Run registered queries against their reference SQL: names, types, rows, values."""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

from pathways.session import configure
from workload.all_queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
}


def session(cores: str = "8") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("check")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    return round(value, 6) if isinstance(value, float) else value


def rows_of(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def compare(name: str, spark: SparkSession, con, folder: str) -> tuple[bool, str]:
    q = QUERIES[name]
    start = time.time()
    df = q(spark, folder)
    got = df.collect()
    took = time.time() - start
    if q.sql is None:
        return True, f"rows only, {len(got)} rows, {took:.1f}s"
    start = time.time()
    result = con.execute(q.sql)
    described = [(d[0], str(d[1])) for d in result.description]
    expected = result.fetchall()
    oracle_took = time.time() - start
    want = {n: t for n, t in described}
    have = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if set(want) != set(have):
        return False, f"columns: missing {set(want) - set(have)} extra {set(have) - set(want)}"
    differing = {c: (have[c], want[c]) for c in want if have[c] != want[c]}
    if len(got) != len(expected):
        return False, f"rows: {len(got)} here, {len(expected)} expected {differing or ''}"
    left = rows_of([tuple(r) for r in got], df.columns)
    right = rows_of(expected, [n for n, _ in described])
    if left != right:
        at = next(i for i, (a, b) in enumerate(zip(left, right)) if a != b)
        return False, f"values at {at}: {left[at]} here, {right[at]} expected, columns {sorted(df.columns)} {differing or ''}"
    if differing:
        return False, f"types (here, expected): {differing}"
    return True, f"{len(got)} rows, {took:.1f}s, reference {oracle_took:.1f}s"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark, con = session(), connection(args.folder)
    failed = []
    for name in args.names or QUERIES:
        try:
            ok, note = compare(name, spark, con, args.folder)
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        print(("ok  " if ok else "FAIL"), name, note, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(args.names or QUERIES) - len(failed)} ok, {len(failed)} failed: {failed}")
    spark.stop()


if __name__ == "__main__":
    main()
