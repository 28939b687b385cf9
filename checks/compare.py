"""Runs queries and their SQL side by side and compares the results value by value.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def local_session(cores: int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strata")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


# Spark types and the DuckDB types that hold the same values.
SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def _normal(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, connection, folder: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = QUERIES[name](spark, folder)
    got_names = df.columns
    got = _normal(got_names, df.collect())
    cursor = connection.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    want = _normal(names, cursor.fetchall())
    if sorted(got_names) != sorted(names):
        return f"columns {sorted(got_names)} against {sorted(names)}"
    types = {c[0]: str(c[1]) for c in cursor.description}
    odd = {n: (t, types[n]) for n, t in df.dtypes if SAME_TYPE.get(t) != types[n]}
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} of {len(got)} rows, such as {bad[0]}" if bad else None


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(QUERIES)
    spark, connection = local_session(), duck(folder)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:  # report it and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - start:6.1f}s {problem or ''}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
