"""Customer history, as-of joins and the idempotent load."""

from datetime import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan, rows
from shopgrain.operators.joins import as_of_join
from shopgrain.operators.merge import row_diff
from shopgrain.plans import audits, star as s
from shopgrain.sources.schemas import STAR_DDL
from shopgrain.sources.versions import VersionedTables

USERS = ("user_id BIGINT, email STRING, full_name STRING, phone STRING, city STRING, "
         "created_at TIMESTAMP_NTZ")
FEED = "user_id BIGINT, email STRING, full_name STRING, city STRING, effective_at TIMESTAMP_NTZ"
T0, T1, T2 = dt(2024, 1, 1), dt(2024, 6, 1), dt(2024, 9, 1, 12)


@pytest.fixture
def first(spark):
    users = [(1, "a@x", "A", None, "Rome", T0), (2, "b@x", "B", None, None, T0),
             (3, "c@x", "C", None, "Oslo", T0)]
    return s.dim_customer(spark.createDataFrame(users, USERS))


def versions(dim):
    return rows(dim.select("user_id", "city", "valid_from", "valid_to", "is_current"))


def feed(spark, *changes):
    return spark.createDataFrame(list(changes), FEED)


def test_fixed_calendar(spark):
    days = s.dim_date(s.date_bounds(spark, dt(2024, 1, 1).date(), dt(2026, 12, 31).date()))
    assert days.count() == 1096
    leap = days.where("date_id = 20240229").first()
    assert tuple(leap)[2:] == (2024, 1, 2, "February", 29, "Thursday", False)
    assert days.where("is_weekend").count() == 156 * 2  # 156 weeks, then Monday to Thursday


def test_initial_load_adds_unseen_users_only(spark, first):
    more = spark.createDataFrame(
        [(1, "a@x", "A", None, "Paris", T1), (4, "d@x", "D", None, "Bern", T1)], USERS)
    assert versions(s.dim_customer(more, first)) == [
        (1, "Rome", T0, None, True), (2, "Unknown", T0, None, True),
        (3, "Oslo", T0, None, True), (4, "Bern", T1, None, True)]


def test_changes_close_and_open(spark, first):
    changes = feed(spark, (1, "a@x", "A", "Paris", T1),    # change
                   (2, "b@x", "B", "Bern", T1),            # NULL to value
                   (3, "c@x", "C", "Oslo", T1),            # no change
                   (9, "z@x", "Z", "Lima", T1))            # unseen user
    after = s.apply_customer_changes(first, changes)
    assert versions(after) == [
        (1, "Paris", T1, None, True), (1, "Rome", T0, T1, False),
        (2, "Bern", T1, None, True), (2, "Unknown", T0, T1, False),
        (3, "Oslo", T0, None, True), (9, "Lima", T1, None, True)]
    assert row_diff(after, s.apply_customer_changes(after, changes)).count() == 0
    assert all(r.violations == 0 for r in audits.scd2_audit(after).collect())

    back = s.apply_customer_changes(after, feed(spark, (2, "b@x", "B", None, T2)))
    assert versions(back.where("user_id = 2")) == [
        (2, "Bern", T1, T2, False), (2, "Unknown", T0, T1, False),
        (2, "Unknown", T2, None, True)]
    keys = [r.customer_key % s.VERSION_SPACE
            for r in back.where("user_id = 2").orderBy("valid_from").collect()]
    assert keys == [0, 1, 2]


def test_late_changes_are_listed_not_applied(spark, first):
    changes = feed(spark, (1, "a@x", "A", "Paris", T0), (3, "c@x", "C", "Lima", dt(2023, 1, 1)))
    assert row_diff(first, s.apply_customer_changes(first, changes)).count() == 0
    assert rows(s.rejected_customer_changes(first, changes).select("user_id", "reason")) == [
        (1, "same instant"), (3, "before open version")]


def test_two_changes_of_one_user_fail(spark, first):
    changes = feed(spark, (1, "a@x", "A", "Paris", T1), (1, "a@x", "A", "Bern", T2))
    with pytest.raises(Exception, match="duplicate upsert key: 1"):
        s.apply_customer_changes(first, changes).collect()


def test_version_number_cannot_leave_its_users_range(spark, first):
    full = first.withColumn("customer_key", F.col("customer_key") + s.VERSION_SPACE - 1)
    with pytest.raises(Exception, match="too many versions of user 1"):
        s.apply_customer_changes(full, feed(spark, (1, "a@x", "A", "Paris", T1))).collect()


def test_as_of_edges(spark, first):
    dim = s.apply_customer_changes(first, feed(spark, (1, "a@x", "A", "Paris", T2)))
    orders = spark.createDataFrame(
        [(1, 1, T0), (2, 1, T2), (3, 1, dt(2023, 12, 31)), (4, 1, dt(2024, 9, 1, 11)),
         (5, 1, dt(2024, 9, 1, 13))],
        "order_id INT, user_id BIGINT, order_date TIMESTAMP_NTZ")
    joined = as_of_join(orders, dim, "user_id", "order_date").select("order_id", "city")
    assert rows(joined) == [(1, "Rome"), (2, "Paris"), (4, "Rome"), (5, "Paris")]


def test_audit_finds_broken_history(spark):
    broken = spark.createDataFrame(
        [(1, 1, T0, T2, False), (2, 1, T1, None, True),        # overlap
         (3, 2, T0, T0, False), (4, 2, T0, None, True),        # empty interval
         (5, 3, T0, None, True), (6, 3, T1, None, False)],     # two open, wrong flag
        "customer_key BIGINT, user_id BIGINT, valid_from TIMESTAMP_NTZ, "
        "valid_to TIMESTAMP_NTZ, is_current BOOLEAN")
    found = {r.rule: (r.violations, r.sample_key) for r in audits.scd2_audit(broken).collect()}
    assert found == {
        "no overlapping versions": (2, "1"), "no empty interval": (1, "3"),
        "is_current means open": (1, "6"), "one open version per user": (1, "3")}


def test_delivery_uses_one_parcel_per_order(spark):
    ddl = ("shipment_id INT, order_id INT, shipped_at TIMESTAMP_NTZ, "
           "delivered_at TIMESTAMP_NTZ")
    parcels = spark.createDataFrame([
        (1, 1, T0, dt(2024, 1, 3, 1)), (2, 1, T1, None),       # later one not delivered yet
        (3, 2, T1, T0), (4, 3, T0, None)], ddl)
    assert rows(s.delivery_by_order(parcels)) == [(1, 2), (2, None), (3, None)]


def test_load_twice_changes_nothing(spark, shop, tmp_path):
    from __spark_entry__ import moves

    tables = VersionedTables(spark, str(tmp_path), STAR_DDL)
    s.load_star(shop, tables, moves(shop))
    before = {name: tables.read(name) for name in s.STAR_TABLES}
    s.load_star(shop, tables, moves(shop))
    check = s.idempotence_check(before, {name: tables.read(name) for name in s.STAR_TABLES})
    assert all(r.rows_gained == r.rows_lost == 0 for r in check.collect())
    assert before["fct_orders"].count() == shop.orders.count()


def test_fact_files_hold_disjoint_dates(spark, shop, tmp_path):
    tables = VersionedTables(spark, str(tmp_path), STAR_DDL)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # else these few rows become one file
    try:
        s.load_star(shop, tables)
    finally:
        spark.conf.set(merging, "true")
    for name in ("fct_orders", "fct_order_items"):
        ranges = sorted((r.a, r.b) for r in tables.read(name).groupBy(F.input_file_name()).agg(
            F.min("order_date_id").alias("a"), F.max("order_date_id").alias("b")).collect())
        assert len(ranges) > 2
        assert all(one[1] <= two[0] for one, two in zip(ranges, ranges[1:]))


def test_feed_adds_up_and_rejects_are_stored(spark, shop, tmp_path):
    from __spark_entry__ import mixed_moves

    feed, tables = mixed_moves(shop), VersionedTables(spark, str(tmp_path), STAR_DDL)
    outcomes = {r.outcome: r.changes for r in s.change_outcomes(s.dim_customer(shop.users), feed).collect()}
    assert set(outcomes) == {"applied", "unchanged", "rejected", "new user"}
    assert sum(outcomes.values()) == feed.count()
    s.load_star(shop, tables, feed)
    assert tables.read(s.REJECTS).count() == outcomes["rejected"]
    versions = tables.read("dim_customer").count()
    assert versions == shop.users.count() + outcomes["applied"] + outcomes["new user"]


def test_unseen_users_of_the_mixed_feed_are_unseen(spark):
    from __spark_entry__ import mixed_moves
    from shopgrain.sources.tables import Shop

    held = [(i, f"{i}@x", "N", None, city, dt(1994, 1, 1)) for i, city in (
        (0, "City 5"), (7, "City 5"), (-7, "City 5"), (-9, "City 1"), (9, "City 5"), (3, "City 0"))]
    users = spark.createDataFrame(held, USERS)
    feed = mixed_moves(Shop(lambda name: users))
    outcomes = {r.outcome: r.changes for r in s.change_outcomes(s.dim_customer(users), feed).collect()}
    assert outcomes == {"unchanged": 4, "new user": 4, "applied": 1, "rejected": 1}


def test_star_audits_find_planted_faults(star):
    clean = {name: df for name, df in star.items()}
    for audit in (audits.star_audit_unique, audits.star_audit_not_null, audits.star_audit_foreign_keys):
        assert all(r.violations == 0 for r in audit(clean).collect())
    items = star["fct_order_items"]
    broken = clean | {
        "fct_order_items": items.withColumns({
            "product_key": F.when(F.col("order_id") % 7 == 0, -1).otherwise(F.col("product_key")),
            "order_item_key": F.lit("one"),
            "quantity": F.when(F.col("order_id") % 5 == 0, None).otherwise(F.col("quantity"))})}
    def found(audit):
        return {(r.table_name, r.rule) for r in audit(broken).collect() if r.violations}
    assert ("fct_order_items", "unique(order_item_key)") in found(audits.star_audit_unique)
    assert found(audits.star_audit_not_null) == {("fct_order_items", "quantity IS NOT NULL")}
    assert found(audits.star_audit_foreign_keys) == {
        ("fct_order_items", "product_key references dim_product")}


def test_history_is_split_at_the_move(star):
    found = {(r.version_no, r.is_current): r
             for r in s.scd2_history_check(star["fct_orders"], star["dim_customer"]).collect()}
    assert found[0, False].last_date_id < 19980601 <= found[1, True].first_date_id
    assert all(r.misplaced == 0 for r in found.values())


def test_the_last_join_of_a_fact_runs_once(spark, shop, tmp_path):
    """Bounds of files come from the keys: drawn from the rows, they have the merge run twice."""
    ranged = []

    class Watched(VersionedTables):
        def write(self, name, df, partition_by=None):
            if name.startswith("fct_"):
                ranged.append("rangepartitioning" in plan(df))
            return super().write(name, df, partition_by)

    watched = Watched(spark, str(tmp_path), STAR_DDL)
    s.load_star(shop, watched)
    s.load_star(shop, watched)
    assert ranged == [False] * 4
    assert watched.read("fct_orders").count() == shop.orders.count()


def test_rows_are_dealt_by_the_ranges_of_their_keys(spark):
    from shopgrain.operators.ranges import cut_by_range, range_starts

    held = [(20240101 + i % 3, i, f"r{i}") for i in range(-200, 400)]  # a busy day spans ranges
    held += [(20240102, None, "no number"), (20250101, 5, "other day"), (None, 7, "no day")]
    df = spark.createDataFrame(held * 2, "day INT, at BIGINT, what STRING").repartition(4)
    n = 8
    starts = range_starts(df.where("at % 2 = 0"), "day", "at", n)
    assert 3 < len(starts) <= n
    cut = cut_by_range(df, starts, [20240101, 20240102, 20240103, 20250101], "day", "at", n)
    assert cut.rdd.getNumPartitions() == n and cut.columns == df.columns
    assert rows(cut) == rows(df)
    parts = [p for p in cut.rdd.glom().collect() if p]
    assert len(parts) > 3
    for p in parts:
        keys = [(r.day, r.at) for r in p if r.day is not None and r.at is not None]
        assert keys == sorted(keys)
    spans = [(min(k), max(k)) for p in parts for k in [[
        (r.day, r.at) for r in p if r.day is not None and r.at is not None]]]
    assert all(one[1] < two[0] for one, two in zip(spans, spans[1:]))
    none = df.where("false")
    assert range_starts(none, "day", "at", n) == [] and cut_by_range(none, [], [], "day", "at", 1).count() == 0


def test_a_repeated_load_shuffles_no_held_rows(spark, shop, tmp_path):
    """Of a fact that is there only keys are read for the merge, and shuffle files go step by step."""
    plans, cleaned = [], []

    class Watched(VersionedTables):
        def write(self, name, df, partition_by=None):
            if name.startswith("fct_"):
                plans.append(f"{tmp_path}/{name}" in plan(df))
            cleaned.append(spark.conf.get(s.CLEAN_UP))
            return super().write(name, df, partition_by)

    watched = Watched(spark, str(tmp_path), STAR_DDL)
    before = spark.conf.get(s.CLEAN_UP)
    s.load_star(shop, watched)
    plans.clear()
    s.load_star(shop, watched)
    # Orders are read for their lines; neither fact is read to be merged with itself.
    assert plans == [False, False] and set(cleaned) == {"true"}
    assert spark.conf.get(s.CLEAN_UP) == before


def test_a_load_keeps_rows_that_the_sources_lost(spark, shop, tmp_path):
    tables = VersionedTables(spark, str(tmp_path), STAR_DDL)
    s.load_star(shop, tables)
    full = {name: tables.read(name) for name in s.STAR_TABLES}

    class Less:
        orders = shop.orders.where("order_id % 3 <> 0")
        order_items = shop.order_items.where("order_id % 3 <> 0")

        def __getattr__(self, name):
            return getattr(shop, name)

    s.load_star(Less(), tables)
    for name in s.STAR_TABLES:
        assert row_diff(full[name], tables.read(name)).count() == 0, name


def test_lines_with_one_order_and_product_twice_fail(spark):
    lines = spark.createDataFrame([(1, 7, 2, 1, 2), (1, 8, 1, 1, 1)],
                                  "order_id BIGINT, product_id BIGINT, quantity INT, unit_price INT, subtotal INT")
    lines = lines.withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")).withColumn(
        "subtotal", F.col("subtotal").cast("decimal(12,2)"))
    orders = spark.createDataFrame([(1, 20240101, 5, 202401), (1, 20240102, 5, 202401)],
                                   "order_id BIGINT, order_date_id INT, customer_key BIGINT, order_month INT")
    products = spark.createDataFrame([(7, 7, 1), (7, 7, 2)], "product_key BIGINT, product_id BIGINT, c INT")
    products = products.select("product_key", "product_id", F.col("c").cast("decimal(10,2)").alias("unit_cost"))
    assert s.fct_order_items(lines, orders, products).count() == 4
    for some, known in ((orders, products.limit(1)), (orders.limit(1), products)):
        with pytest.raises(PySparkException, match="duplicate upsert key: 1, 7"):
            s.fct_order_items(lines, some, known, reject=True).collect()
    once = s.fct_order_items(lines, orders.limit(1), products.limit(1), reject=True)
    assert [r.order_item_key for r in once.collect()] == ["1-7"]
    # A line of an unknown product is left out, twice or not.
    assert s.fct_order_items(lines.where("product_id = 8"), orders, products, reject=True).count() == 0


def test_a_load_replaces_all_columns_or_some(spark, shop, tmp_path):
    class Raised:
        orders = shop.orders.withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(12,2)")) \
            .withColumn("order_status", F.lit("changed"))

        def __getattr__(self, name):
            return getattr(shop, name)

    for frozen, raised in ((None, 1), ({"fct_orders": ["order_status"]}, 0)):
        tables = VersionedTables(spark, f"{tmp_path}/{raised}", STAR_DDL)
        s.load_star(shop, tables)
        before = tables.read("fct_orders")
        s.load_star(Raised(), tables, update_cols=frozen)
        old = before.select("order_key", "order_month", F.col("total_amount").alias("old"))
        both = tables.read("fct_orders").join(old, ["order_key", "order_month"])
        found = both.groupBy("order_status", (F.col("total_amount") - F.col("old")).cast("int").alias("by")).count()
        assert rows(found) == [("changed", raised, shop.orders.count())]
