"""The text queries that SQL can express, against their SQL; all of them run."""

import pytest

from oracle_check import compare, connect
from shopgrain.llm.oracle import oracle_sql
from shopgrain.llm.queries import queries


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, folder, name):
    _, fault = compare(spark, connect(folder), folder, name, queries()[name], oracle_sql()[name])
    assert fault is None
