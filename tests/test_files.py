"""Merges that rewrite only the files they touch, and commits that do not overlap."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from shopgrain.operators.merge import fingerprints, row_diff, row_diff_by, upsert
from shopgrain.sources import tables
from shopgrain.sources.files import CommitConflict, FileTable

SCHEMA = "id BIGINT, day INT, value STRING"


@pytest.fixture
def stored(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], "day", file_rows=100)
    table.write(days(spark, range(1, 41)))
    return table


def days(spark, numbers, value="old"):
    return spark.createDataFrame([(100 * d + k, d, f"{value} {k}") for d in numbers for k in range(20)], SCHEMA)


def contents(table):
    out = {}
    for f in table.files():
        path = f["path"].removeprefix("file://")
        with open(path, "rb") as data:
            out[path] = (data.read(), os.stat(path).st_mtime_ns)
    return out


def test_a_changed_day_leaves_other_files_alone(spark, stored):
    before, held = contents(stored), stored.files()
    assert len(held) > 3 and sum(f["rows"] for f in held) == 800
    done = stored.merge(days(spark, [17], "new"))
    hit = [f for f in held if f["low"] <= 17 <= f["high"]]
    assert done["rewritten"] == len(hit) < len(held) and done["kept"] == len(held) - len(hit)
    after = contents(stored)
    kept = set(before) & set(after)
    assert len(kept) == done["kept"] and all(before[p] == after[p] for p in kept)
    want = upsert(days(spark, range(1, 41)), days(spark, [17], "new"), ["id"])
    assert rows(stored.read()) == rows(want)
    assert rows(stored.read(version=1)) == rows(days(spark, range(1, 41)))


def test_new_days_rewrite_nothing_and_the_same_load_again_changes_nothing(spark, stored):
    new = days(spark, [50, 51], "new")
    assert stored.merge(new)["rewritten"] == 0
    once = rows(stored.read())
    stored.merge(new)
    assert rows(stored.read()) == once and len(once) == 840
    assert stored.merge(new.limit(0))["written"] == 0
    frozen = days(spark, [50], "newer")
    stored.merge(frozen, update_cols=[])
    assert rows(stored.read()) == once


def test_ranges_open_only_their_files(spark, stored):
    part = stored.read(10, 12)
    assert rows(part) == rows(days(spark, [10, 11, 12]))
    hit = [f for f in stored.files() if f["high"] >= 10 and f["low"] <= 12]
    assert len(part.inputFiles()) == len(hit) < len(stored.files())
    assert stored.read(90, 99).count() == 0


def test_two_loads_at_once_give_one_success_and_one_clean_failure(spark, stored, monkeypatch):
    other = FileTable(spark, stored._root, SCHEMA, ["id"], "day", file_rows=100)
    store = other._store

    def slow(df):
        files = store(df)
        stored.merge(days(spark, [3], "first"))  # the faster load, between reading and storing
        return files

    monkeypatch.setattr(other, "_store", slow)
    with pytest.raises(CommitConflict, match="version 2"):
        other.merge(days(spark, [4], "second"))
    want = upsert(days(spark, range(1, 41)), days(spark, [3], "first"), ["id"])
    assert rows(stored.read()) == rows(want) and stored.versions() == [1, 2]
    monkeypatch.undo()
    other.merge(days(spark, [4], "second"))
    assert rows(stored.read()) == rows(upsert(want, days(spark, [4], "second"), ["id"]))


def test_rows_that_move(spark, stored):
    moved = spark.createDataFrame([(305, 30, "moved"), (4000, 3, "came")], SCHEMA)
    stored.merge(moved, moves=True)
    want = upsert(days(spark, range(1, 41)), moved, ["id"])
    assert rows(stored.read()) == rows(want)
    with pytest.raises(Exception, match="duplicate upsert key"):
        stored.merge(moved.union(moved))
    assert rows(stored.read()) == rows(want)


def test_old_versions_expire(spark, stored):
    for d in (1, 2, 3):
        stored.merge(days(spark, [d], f"v{d}"))
    want, old = rows(stored.read()), stored.files(1)
    assert stored.expire(2) > 0
    assert stored.versions() == [3, 4] and rows(stored.read()) == want
    assert rows(stored.read(version=3)) != want
    gone = [f for f in old if not os.path.exists(f["path"].removeprefix("file://"))]
    assert gone and not {f["path"] for f in gone} & {f["path"] for f in stored.files(3)}
    with pytest.raises(ValueError, match="at least one"):
        stored.expire(0)


def test_fingerprints_find_a_planted_row(spark):
    before = days(spark, range(1, 41)).unionByName(days(spark, [5]).limit(3))
    for change in (
        before.withColumn("value", F.when(F.col("id") == 1703, "x").otherwise(F.col("value"))),
        before.where("id <> 805"), before.unionByName(days(spark, [77])),
        before.withColumn("day", F.when(F.col("id") == 912, F.lit(None)).otherwise(F.col("day"))),
    ):
        assert rows(row_diff_by(before, change, "day")) == rows(row_diff(before, change))
    same = row_diff_by(before, before.repartition(5), "day")
    assert same.count() == 0 and "FileScan" not in plan(same)
    assert fingerprints(before, "day").count() == 40


def test_reload_reads_its_own_table_and_keeps_the_old_one(spark, tmp_path):
    path = str(tmp_path / "copies" / "t")
    first = tables.reload_parquet(days(spark, [1, 2]), path)
    second = tables.reload_parquet(first.where("day = 2"), path)
    assert rows(second) == rows(days(spark, [2])) and rows(first) == rows(days(spark, [1, 2]))


def test_defaults_of_a_load(spark):
    users = spark.createDataFrame([(1, "a@x", "A", "Rome"), (2, "b@x", "B", None)],
                                  "user_id BIGINT, email STRING, full_name STRING, city STRING")
    got = tables.with_defaults(users, "users", "2024-05-06 07:08:09")
    assert [str(r["created_at"]) for r in got.collect()] == ["2024-05-06 07:08:09"] * 2
    assert got.columns == ["user_id", "email", "full_name", "phone", "city", "created_at"]
    held = got.withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    assert {r["created_at"] for r in tables.with_defaults(held, "users", "2024-01-01").collect()} == {None}
    with pytest.raises(ValueError, match="users needs a column email"):
        tables.with_defaults(users.drop("email"), "users", "2024-01-01")


def test_fingerprints_sum_whole_numbers(spark):
    """Decimals that hold the sum of 64-bit hashes cost more than the hashes."""
    sums = fingerprints(days(spark, range(1, 41)).unionByName(days(spark, range(1, 3))), "day")
    assert "decimal" not in plan(sums).lower()
    hashes = {r.day: r for r in sums.collect()}
    assert (hashes[1].n, hashes[3].n) == (40, 20) and 0 <= hashes[1].one.p1 < 40 << 16
    assert len({r.one for r in hashes.values()} | {r.two for r in hashes.values()}) == 80
