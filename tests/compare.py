"""Run catalogue queries on Spark and their SQL on DuckDB, and compare all rows.

``python tests/compare.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    if isinstance(value, bytearray):
        return bytes(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


# What each Spark type is called in DuckDB.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a DataFrame and a SQL result, or None."""
    result = connection.execute(sql)
    names = [entry[0] for entry in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {entry[0]: str(entry[1]) for entry in result.description}
    other = {
        name: f"{kind} / {types[name]}"
        for name, kind in df.dtypes
        if SAME_TYPE.get(kind) != types[name]
    }
    if other:
        return f"types {other}"
    expected = _sorted_rows(names, result.fetchall())
    found = _sorted_rows(df.columns, df.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}; {found[:2]} / {expected[:2]}"
    for mine, theirs in zip(found, expected):
        if mine != theirs:
            return f"{mine} != {theirs}"
    return None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("postlane-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as contract

    spark, connection = session(), connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failures = 0
    for name in wanted or queries:
        begun = time.time()
        try:
            found = difference(queries[name](spark, sf_dir), connection, oracles[name])
        except Exception as problem:  # noqa: BLE001 - report and go on
            found = f"{type(problem).__name__}: {str(problem)[:600]}"
        failures += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - begun:.1f}s {found or ''}", flush=True)
    print(f"{failures} of {len(wanted or queries)} differ")
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.001", arguments[1:]) > 0)
