"""Run registered queries against their SQL; also a command line: compare.py SF_DIR [NAME ...]."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((plain(row[i]), type(row[i]).__name__) for i in order) for row in rows)


def differences(spark: SparkSession, connection, sf_dir: str, query, sql: str) -> tuple[int, list[str]]:
    """Number of rows and what differs, if anything does."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    names = [item[0] for item in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    if mine != theirs:
        found.append(f"rows only here {list((mine - theirs).items())[:2]}")
        found.append(f"rows only there {list((theirs - mine).items())[:2]}")
        found.append(f"counts {mine.total()} / {theirs.total()}, differing {(mine - theirs).total()}")
    return mine.total(), found


def main(sf_dir: str, *wanted: str) -> int:
    import __spark_entry__ as registered
    from conftest import new_session

    spark = new_session()
    connection = engine(sf_dir)
    failed = 0
    for name, sql in registered.oracle_sql().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            count, found = differences(spark, connection, sf_dir, registered.queries()[name], sql)
        except Exception as error:  # noqa: BLE001 - reported
            count, found = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':5}{name:28}{count:8} rows {time.time() - start:6.2f}s", flush=True)
        for line in found:
            print("      ", line[:900])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
