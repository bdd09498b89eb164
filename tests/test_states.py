"""Activity states that take deltas, and row frames over buckets with halos."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from conftest import plan, rows
from shopgrain.operators import bitmaps
from shopgrain.operators.halo import with_halo
from shopgrain.plans import questions as q


def test_any_split_into_deltas_gives_the_same_cohorts(spark, shop):
    want = rows(q.cohort_retention(shop.orders))
    rng = random.Random(3)
    for cuts in (1, 4):
        parts = [shop.orders.where(F.pmod(F.xxhash64("order_id"), F.lit(cuts)) == k) for k in range(cuts)]
        parts.append(rng.choice(parts))  # a delta that is taken twice
        rng.shuffle(parts)
        state = q.activity_delta(parts[0])
        for part in parts[1:]:
            state = bitmaps.merge(state, q.activity_delta(part))
        assert rows(q.cohort_retention_of_state(state)) == want
        assert state.groupBy("user_id", "word").count().where("count > 1").count() == 0


def test_months_of_a_state(spark):
    seen = [(1, 0), (1, 59), (1, 60), (1, 61), (2, 24000), (2, 24000), (3, None), (None, 5)]
    df = spark.createDataFrame(seen, "u BIGINT, m INT")
    state = bitmaps.activity(df, "u", F.col("m"))
    assert rows(bitmaps.months(state)) == sorted(
        {(u, m) for u, m in seen if u and m is not None}, key=lambda r: [(True, str(v)) for v in r])
    counts = {(r["cohort"], r["month_offset"]) for r in bitmaps.retention_counts(state).collect()}
    assert counts == {(0, 0), (0, 59), (0, 60), (0, 61), (24000, 0)}


@pytest.mark.parametrize("days", [1, 3, 20, 1000])
def test_frames_over_buckets_equal_frames_over_keys(spark, days):
    rng = random.Random(days)
    start = date(2024, 1, 1)
    at = sorted(rng.sample(range(400), 150))
    data = [(1, start + timedelta(days=d), rng.randrange(100)) for d in at]
    data += [(2, start, 5), (3, start, 1), (3, start + timedelta(days=399), 2)]
    df = spark.createDataFrame(data, "k INT, day DATE, v INT")

    def framed(rows_of, *keys):
        frame = W.partitionBy(*keys).orderBy("day").rowsBetween(-6, 0)
        return rows_of.withColumn("s", F.sum("v").over(frame)).withColumn("n", F.count("v").over(frame))

    buckets = with_halo(df, ["k"], "day", F.floor(F.unix_date("day") / days), 6)
    got = framed(buckets, "k", "_bucket").where("NOT _halo").drop("_halo", "_bucket")
    assert rows(got) == rows(framed(df, "k"))
    sizes = buckets.where("_halo").groupBy("k", "_bucket").count().agg(F.max("count")).first()[0]
    assert sizes is None or sizes <= 6
    if days == 20:
        assert buckets.where("k = 1").select("_bucket").distinct().count() > 10


def test_keys_of_few_rows_have_no_halo(spark):
    """Halos of sparse keys would outweigh their rows; NULL keys count as a key."""
    start = date(2024, 1, 1)
    data = [(k, start + timedelta(days=30 * d), d) for k in (1, 2, None) for d in range(20)]
    data += [(k, start + timedelta(days=d), d) for k in (3, None) for d in range(200)]
    df = spark.createDataFrame(data, "k INT, day DATE, v INT")
    buckets = with_halo(df, ["k"], "day", F.floor(F.unix_date("day") / 30), 6)
    assert {r["k"] for r in buckets.where("_halo").select("k").distinct().collect()} == {3, None}
    assert buckets.where("NOT _halo").count() == len(data)
    assert buckets.where("k IS NULL").select("_bucket").distinct().count() > 10


def test_daily_sales_are_made_once(spark, shop):
    """Rows and halos read what has been written, and not the lines and orders again."""
    text = plan(q.moving_avg_7_bucketed(shop.order_items, shop.orders, shop.products))
    assert "lineitem.parquet" not in text and "orders.parquet" not in text
    assert rows(q.moving_avg_7_bucketed(shop.order_items, shop.orders, shop.products)) == rows(
        q.moving_avg_7(shop.order_items, shop.orders, shop.products))
