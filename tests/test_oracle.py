"""Every registered query against its SQL in the checking engine."""

import pytest

from __spark_entry__ import _text_queries, queries
from oracle.sql import all_sql
from oracle_check import compare, connect

BUILT = {name: build for name, build in queries().items() if name not in _text_queries()}
SQL = all_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(BUILT) == set(SQL)


@pytest.mark.parametrize("name", list(BUILT))
def test_query(spark, con, folder, name):
    _, fault = compare(spark, con, folder, name, BUILT[name], SQL[name])
    assert fault is None
