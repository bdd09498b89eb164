import pytest
from pyspark.errors import PySparkException

from conftest import rows
from shopgrain.operators.merge import (
    held_apart, insert_if_absent, replace_rows, row_diff, update_from, upsert,
)

DDL = "k INT, a STRING, b INT"


@pytest.fixture
def held(spark):
    return spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "same", 3)], DDL)


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame([(1, "new", None), (3, "same", 3), (4, "w", 4)], DDL)


def test_upsert_updates_every_column_and_takes_null(held, incoming):
    assert rows(upsert(held, incoming, ["k"])) == [
        (1, "new", None), (2, "y", 2), (3, "same", 3), (4, "w", 4)]


def test_upsert_freezes_other_columns(held, incoming):
    assert rows(upsert(held, incoming, ["k"], ["a"])) == [
        (1, "new", 1), (2, "y", 2), (3, "same", 3), (4, "w", 4)]


def test_upsert_twice_changes_nothing(held, incoming):
    once = upsert(held, incoming, ["k"])
    assert row_diff(once, upsert(once, incoming, ["k"])).count() == 0


def test_upsert_of_unknown_column(held, incoming):
    with pytest.raises(ValueError):
        upsert(held, incoming, ["k"], ["k"])


def test_upsert_rejects_repeated_key(held, incoming):
    with pytest.raises(PySparkException, match="duplicate upsert key: 1"):
        upsert(held, incoming.unionByName(incoming.where("k = 1")), ["k"]).collect()


def test_insert_if_absent_keeps_held_rows(held, incoming):
    assert rows(insert_if_absent(held, incoming, ["k"])) == [
        (1, "x", 1), (2, "y", 2), (3, "same", 3), (4, "w", 4)]


def test_update_from_leaves_unmatched_rows(spark, held):
    source = spark.createDataFrame([(1, 10), (2, None), (9, 9)], "k INT, total INT")
    assert rows(update_from(held, source, ["k"], {"b": "total"})) == [
        (1, "x", 10), (2, "y", None), (3, "same", 3)]


def test_row_diff_counts_copies(spark, held):
    doubled = held.unionByName(held.where("k = 2")).where("k <> 1")
    assert rows(row_diff(held, doubled)) == [(1, "x", 1, -1), (2, "y", 2, 1)]


def test_replaced_rows_are_those_of_an_upsert(spark, held, incoming):
    held = held.unionByName(held.where("k = 3")).unionByName(
        spark.createDataFrame([(None, "no key", 5), (2, "again", 6)], DDL))
    incoming = incoming.unionByName(spark.createDataFrame([(None, "new without", 7)], DDL))
    apart = held_apart(held, incoming, ["k"])
    assert rows(apart) == [(None, 1, True), (2, 2, True), (3, 2, False)]
    assert rows(replace_rows(held, incoming, ["k"], apart)) == rows(upsert(held, incoming, ["k"]))


def test_a_repeated_load_holds_nothing_apart(held):
    assert held_apart(held, held, ["k"]) is None
    assert rows(replace_rows(held, held, ["k"], None)) == rows(held)
