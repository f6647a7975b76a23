"""Run registered queries next to their SQL and report any difference.

Usage: python tests/check_oracle.py <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

# Spark and DuckDB names of the same type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """Empty text if the query and its SQL agree in columns, types and values."""
    found = entry.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in found.collect()]
    result = con.execute(entry.oracle_sql()[name])
    wanted_types = {column[0]: str(column[1]) for column in result.description}
    wanted = result.fetchall()
    got_types = {field: TYPES.get(kind, kind) for field, kind in found.dtypes}
    if got_types != wanted_types:
        return f"types {sorted(got_types.items())} != {sorted(wanted_types.items())}"
    left, right = rows_of(found.columns, got), rows_of(list(wanted_types), wanted)
    if left != right:
        odd = [pair for pair in zip(left, right) if pair[0] != pair[1]][:3]
        return f"{len(left)} rows != {len(right)} rows or values differ: {odd}"
    return "" if left else "no rows"


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(sf_dir)
    for name in names:
        start = time.monotonic()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.monotonic() - start:6.2f}s  {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
