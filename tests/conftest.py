from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pressmark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def each(spark):
    """Apply a column function to many argument tuples at once."""
    from pyspark.sql import functions as F

    def run(function, rows):
        rows = [row if isinstance(row, tuple) else (row,) for row in rows]
        names = [f"c{i}" for i in range(len(rows[0]))]
        schema = "n int, " + ", ".join(f"{name} string" for name in names)
        frame = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], schema)
        found = frame.select("n", function(*[F.col(name) for name in names]).alias("x")).collect()
        return [row["x"] for row in sorted(found, key=lambda row: row["n"])]

    return run
