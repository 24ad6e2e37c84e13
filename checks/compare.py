"""Run registered queries on both engines and compare their rows.

    python -m checks.compare [/path/to/sf] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(value):
    return round(value, 9) if isinstance(value, float) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(con: duckdb.DuckDBPyConnection, name: str, result: DataFrame) -> str | None:
    """What differs between a Spark result and its check, or None."""
    cursor = con.execute(ORACLES[name])
    want_columns, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_columns, got = _rows(result.columns, [tuple(row) for row in result.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return None
    extra = [row for row in got if row not in set(want)][:3]
    lacking = [row for row in want if row not in set(got)][:3]
    return f"{len(got)} rows, wanted {len(want)}; extra {extra}; lacking {lacking}"


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(ORACLES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.perf_counter()
        try:
            found = differences(con, name, QUERIES[name](spark, sf_dir))
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1200]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.perf_counter() - started:.1f}s {found or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
