"""Compare queries with their SQL: ``python -m checks.compare FOLDER [QUERY ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from pressmark.session import local_session


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def sorted_rows(rows: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, as sorted text."""
    columns = sorted(rows.columns)
    return sorted(tuple(_text(v) for v in row) for row in rows[columns].itertuples(index=False, name=None))


def _text(value: object) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "NULL"
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    if isinstance(value, float):
        return repr(round(value, 6))
    return str(value)


def differences(spark: SparkSession, connection: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """Empty when both sides agree, else the first difference."""
    found = QUERIES[name](spark, folder).toPandas().astype(object)
    if name not in ORACLE:
        return "" if len(found) else "no rows"
    wanted = connection.execute(ORACLE[name]).df().astype(object)
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} and {sorted(wanted.columns)}"
    ours, theirs = sorted_rows(found), sorted_rows(wanted)
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for ours_row, theirs_row in zip(ours, theirs):
        if ours_row != theirs_row:
            apart = [(a, b) for a, b in zip(ours_row, theirs_row) if a != b][0]
            at = next((i for i, (a, b) in enumerate(zip(*apart)) if a != b), min(map(len, apart)))
            return f"at {at}: {apart[0][max(0, at - 60):at + 60]!r} and {apart[1][max(0, at - 60):at + 60]!r}"
    return ""


def main(folder: str, *names: str) -> int:
    spark, connection, bad = local_session("8"), database(folder), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        start = time.time()
        try:
            found = differences(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001 - one failing query must not hide the others
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{name:24s} {time.time() - start:6.1f} s  {found or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
