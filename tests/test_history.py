"""As-of joins by carrying forward, and histories that take changes in any order."""

import random
from datetime import datetime as dt, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from shopgrain.operators.carry import as_of_carry
from shopgrain.operators.joins import as_of_join
from shopgrain.operators.timeline import distinct_events, repoint, splice, timeline

FACTS = "order_id INT, user_id BIGINT, order_date TIMESTAMP_NTZ"
VERSIONS = "user_id BIGINT, city STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ"
EVENTS = "user_id BIGINT, city STRING, at TIMESTAMP_NTZ"
START = dt(2024, 1, 1)


def history(rng, users, changes, days):
    """Versions without overlap, some users with gaps or with an end."""
    out = []
    for user in range(users):
        at = sorted(START + timedelta(minutes=rng.randrange(days * 1440)) for _ in range(changes))
        at = sorted(set(at))
        for k, begin in enumerate(at):
            end = at[k + 1] if k + 1 < len(at) else (None if user % 2 else begin + timedelta(days=3))
            if end and rng.random() < 0.1:
                end = begin + (end - begin) / 2
            out.append((user, f"c{k}", begin, end))
    return out


@pytest.mark.parametrize("bucket_rows", [1, 7, 40, 1 << 16])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_carry_equals_the_interval_join(spark, bucket_rows, how):
    rng = random.Random(bucket_rows)
    held = history(rng, 4, 25, 60)
    orders = [(k, rng.choice([0, 0, 0, 1, 2, 3, 9]), START + timedelta(
        minutes=rng.randrange(-1440, 62 * 1440))) for k in range(600)]
    orders += [(1000 + k, u, at) for k, (u, _, at, _) in enumerate(held)]   # at the very start
    orders += [(2000, None, START), (2001, 1, None)]
    facts, versions = spark.createDataFrame(orders, FACTS), spark.createDataFrame(held, VERSIONS)
    got = as_of_carry(facts, versions, "user_id", "order_date", how=how, bucket_rows=bucket_rows)
    want = as_of_join(facts, versions, "user_id", "order_date", how=how)
    assert rows(got.select(want.columns)) == rows(want)


def test_hot_user_spans_tasks(spark):
    """One user with most orders and versions: no product, and several buckets."""
    n, m = 100_000, 10_000
    facts = spark.range(n).select(
        F.col("id").cast("int").alias("order_id"), F.expr("id div 1000000 + 1").alias("user_id"),
        F.expr("TIMESTAMP_NTZ'2020-01-01' + make_dt_interval(0, 0, CAST(id % 500000 * 17 AS INT))")
        .alias("order_date"))
    starts = spark.range(m).select(
        F.expr("id div 1000000 + 1").alias("user_id"), F.concat(F.lit("c"), "id").alias("city"),
        F.expr("TIMESTAMP_NTZ'2020-01-01' + make_dt_interval(0, 0, CAST(id * 170 AS INT))")
        .alias("valid_from"))
    versions = starts.withColumn("valid_to", F.expr(
        "CASE WHEN city <> 'c9999' THEN valid_from + INTERVAL 170 MINUTES END"))
    got = as_of_carry(facts, versions, "user_id", "order_date", bucket_rows=5000)
    assert got.count() == n
    assert got.where("city <> concat('c', CAST(least(floor(order_id / 10), 9999) AS STRING))").count() == 0
    text = plan(got)
    assert not any(x in text for x in ("CartesianProduct", "BroadcastNestedLoopJoin"))
    used = got.groupBy(F.spark_partition_id()).count().count()
    assert used > 1


def state(result):
    return rows(result.select("user_id", "city", "valid_from", "valid_to", "is_current"))


def test_any_order_of_the_same_changes_gives_the_same_history(spark):
    rng = random.Random(5)
    first = spark.createDataFrame([(u, "a", START) for u in range(6)], EVENTS)
    changes = [(u, rng.choice("abc"), START + timedelta(days=rng.randrange(-5, 30)))
               for u in range(8) for _ in range(6)]
    whole = timeline(distinct_events(first.union(spark.createDataFrame(changes, EVENTS)),
                                     "user_id", ["city"], "at"), "user_id", ["city"], "at")
    want = state(whole)
    for cut in (1, 3):
        rng.shuffle(changes)
        held, versions = first, timeline(first, "user_id", ["city"], "at")
        for k in range(cut):
            step = splice(held, versions, spark.createDataFrame(changes[k::cut], EVENTS),
                          "user_id", ["city"], "at")
            held, versions = step.events, step.versions
        assert state(versions) == want
        again = splice(held, versions, spark.createDataFrame(changes, EVENTS), "user_id", ["city"], "at")
        assert again.changed.count() == 0 and state(again.versions) == want


def test_late_changes_by_choice(spark):
    held = spark.createDataFrame([(1, "a", START), (1, "b", START + timedelta(days=9)), (2, "x", START)],
                                 EVENTS)
    versions = timeline(held, "user_id", ["city"], "at")
    feed = spark.createDataFrame([(1, "m", START + timedelta(days=3)), (1, "n", START + timedelta(days=12)),
                                  (2, "x", START + timedelta(days=1))], EVENTS)
    day = [START + timedelta(days=k) for k in range(13)]
    taken = splice(held, versions, feed, "user_id", ["city"], "at")
    assert state(taken.versions) == sorted([
        (1, "a", day[0], day[3], False), (1, "m", day[3], day[9], False),
        (1, "b", day[9], day[12], False), (1, "n", day[12], None, True), (2, "x", day[0], None, True)],
        key=str)
    assert taken.rejected.count() == 0
    # Only versions of the user with a real change are reported as changed.
    assert {r["user_id"] for r in taken.changed.collect()} == {1}
    strict = splice(held, versions, feed, "user_id", ["city"], "at", late="reject")
    assert rows(strict.rejected) == [(1, "m", day[3])]
    assert (1, "b", day[9], day[12], False) in state(strict.versions)
    with pytest.raises(ValueError, match="late is apply or reject"):
        splice(held, versions, feed, "user_id", ["city"], "at", late="drop")


def test_only_orders_in_changed_versions_are_pointed_anew(spark):
    day = [START + timedelta(days=k) for k in range(13)]
    facts = spark.createDataFrame(
        [(k, 1, day[k], "old") for k in range(10)] + [(20, 2, day[1], "old"), (21, None, day[1], "old")],
        "order_id INT, user_id BIGINT, order_date TIMESTAMP_NTZ, city STRING")
    changed = spark.createDataFrame([(1, "m", day[3], day[6]), (1, "n", day[9], None)], VERSIONS)
    got = {r["order_id"]: r["city"] for r in repoint(
        facts, changed, "user_id", "order_date", {"city": "city"}).collect()}
    assert got == {k: "m" if 3 <= k < 6 else "n" if k == 9 else "old" for k in [*range(10), 20, 21]}


def test_users_of_one_bucket_are_not_dealt_by_day(spark):
    """The days of large users are known before the plan: without any, events are shuffled once."""
    rng = random.Random(3)
    orders = [(k, k % 5, START + timedelta(minutes=rng.randrange(80000))) for k in range(300)]
    facts = spark.createDataFrame(orders, FACTS)
    versions = spark.createDataFrame(history(rng, 5, 9, 60), VERSIONS)
    text = plan(as_of_carry(facts, versions, "user_id", "order_date"))
    assert text.count("Arguments: hashpartitioning") == 1


def test_a_splice_is_worked_out_once(spark):
    held = spark.createDataFrame([(1, "a", START), (2, "x", START)], EVENTS)
    feed = spark.createDataFrame([(1, "b", START + timedelta(days=3)), (None, "n", START)], EVENTS)
    versions = timeline(held, "user_id", ["city"], "at")
    step = splice(held, spark.createDataFrame(versions.collect(), versions.schema), feed,
                  "user_id", ["city"], "at")
    for df in (step.events, step.versions, step.changed):
        assert "Window" not in plan(df)
    assert (None, "n", START, None, True) in state(step.versions) and step.rejected.count() == 0
