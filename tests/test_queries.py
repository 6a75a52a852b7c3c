"""Every registered query against its SQL, and the driver contract."""

import re

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    """All queries of the reference's work have SQL; the numbered ones and the pipeline have tests of their own."""
    numbered = {n for n in queries() if re.match(r"op\d+_", n) or n == "pipeline"}
    assert set(oracle_sql()) - numbered == set(queries()) - numbered
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, connection, name):
    assert not differences(queries()[name](spark, FOLDER), connection, oracle_sql()[name])
