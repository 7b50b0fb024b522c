from __future__ import annotations

from pathlib import Path

import pytest

from checks.compare import database, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return database(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"classify_documents", "kfold_metrics"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(spark, connection, FOLDER, name) == ""
