"""The plans stay free of what does not scale, and hot keys do not change results."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import (
    _layout_queries, _shop_queries, _star_queries, _trip_queries, queries,
)
from conftest import plan, rows
from shopgrain.plans import audits, questions as q
from shopgrain.session import materialise
from shopgrain.sources.roles import role_shop, trips

UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
            "MapInPandas", "PythonUDF", "CollectLimit"]


@pytest.mark.parametrize("name", [
    *_shop_queries(), *_trip_queries(), *_star_queries(), *_layout_queries(), "pit_features",
    "asof_carry", "scd2_late_changes", "scd2_repointed_orders", "incremental_load", "load_defaults"])
def test_plan_shape(spark, folder, name):
    text = plan(queries()[name](spark, folder))
    assert not [node for node in UNWANTED if node in text]


def test_ranks_are_cut_before_the_shuffle(shop):
    for df in (q.second_order_gap(shop.orders), q.top3_per_category(
            shop.categories, shop.products, shop.order_items, shop.orders)):
        assert "WindowGroupLimit" in plan(df)


def test_left_join_with_not_null_becomes_inner(shop):
    text = plan(q.active_users_left_form(shop.users, shop.orders))
    assert "Join type: Inner" in text and "Join type: LeftOuter" not in text


def test_scan_reads_only_needed_columns(spark, folder):
    text = plan(q.category_sales(role_shop(spark, folder).order_items,
                                 role_shop(spark, folder).products, 3))
    assert ("ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>"
            in text)
    assert "ReadSchema: struct<l_quantity:double>" in plan(
        trips(spark, folder).agg(F.max("trip_distance")))


@pytest.fixture(scope="module")
def skewed(shop):
    """A third of all orders by one user, a third of all lines in one order of one product."""
    orders = shop.orders.withColumn(
        "user_id", F.when(F.col("order_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    lines = shop.order_items.withColumn(
        "order_id", F.when(F.col("quantity") % 3 == 0, F.lit(1)).otherwise(F.col("order_id"))
    ).withColumn(
        "product_id", F.when(F.col("quantity") % 3 == 0, F.lit(42)).otherwise(F.col("product_id")))
    return orders, lines


def test_hot_user_and_hot_order_against_plain_sql(spark, shop, skewed):
    orders, lines = skewed
    orders.createOrReplaceTempView("so")
    lines.createOrReplaceTempView("sl")
    shop.products.createOrReplaceTempView("sp")
    rates = q.return_rate_products(shop.products, lines, orders, min_orders=1, k=10**6)
    plain = spark.sql("""SELECT p.product_id, COUNT(DISTINCT o.order_id) AS n,
        SUM(CASE WHEN order_status IN ('cancelled', 'returned') THEN 1 ELSE 0 END) AS bad
        FROM sp p JOIN sl l ON p.product_id = l.product_id JOIN so o ON l.order_id = o.order_id
        GROUP BY 1""")
    assert rows(rates.select("product_id", "total_orders", "returned_or_cancelled")) \
        == rows(plain)
    again = q.repeat_purchase_rate(lines, orders).first()
    plain = spark.sql("""SELECT COUNT(DISTINCT product_id), COUNT(DISTINCT CASE WHEN n > 1 THEN
        product_id END) FROM (SELECT user_id, product_id, COUNT(DISTINCT o.order_id) AS n
        FROM so o JOIN sl l ON o.order_id = l.order_id WHERE order_status = 'completed'
        GROUP BY 1, 2)""").first()
    assert tuple(again)[:2] == tuple(plain)


def test_hot_order_is_split_at_run_time(spark, shop, skewed):
    """With size limits scaled down to the test data, AQE cuts the partition of the hot order,
    also where the rows are then grouped by that order."""
    orders, lines = skewed
    lines = lines.withColumn("product_id", F.xxhash64("item_id"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {key: spark.conf.get(key) for key in small}
    lines, orders = (materialise(df.repartition(8), "skew") for df in (lines, orders))
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        for df in (q.product_sales(lines, orders),
                   q.return_rate_products(shop.products, lines, orders, 1, 10)):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_orphans_are_counted_once_per_row(spark, shop):
    class Broken:
        def table(self, name):
            df = shop.table(name)
            return df.where("user_id <> 7") if name == "users" else df

    found = {(r.table_name, r.rule): r for r in audits.audit_foreign_keys(Broken()).collect()}
    orphans = found["orders", "user_id references users"]
    assert orphans.violations == shop.orders.where("user_id = 7").count() > 0
    assert orphans.sample_key == "7"


def test_shuffles_grow_with_the_tables(spark, tmp_path):
    from shopgrain.session import INPUT_BYTES_PER_PARTITION, size_shuffles

    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    held = [spark.conf.get(n, None) for n in names]
    try:
        (tmp_path / "t.parquet").write_bytes(bytes(40 * INPUT_BYTES_PER_PARTITION))
        size_shuffles(spark, str(tmp_path))
        assert spark.range(10).groupBy("id").count().rdd.getNumPartitions() <= 40  # merged again
        shuffled = spark.range(100_000).repartition("id")
        assert "hashpartitioning(id#" in plan(shuffled) and ", 40)" in plan(shuffled)
        size_shuffles(spark, str(tmp_path / "none"))
        assert ", 8)" in plan(spark.range(100_000).repartition("id"))
    finally:
        for n, v in zip(names, held):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_a_task_takes_in_little(spark, tmp_path):
    """A shuffled megabyte is some forty of memory in the grouping of lines by order and product."""
    from shopgrain.session import size_shuffles

    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    held = [spark.conf.get(n, None) for n in names]
    try:
        size_shuffles(spark, str(tmp_path))
        assert int(spark.conf.get(names[1])) <= 4 << 20
    finally:
        for n, v in zip(names, held):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
