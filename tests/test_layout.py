"""Layouts give the same rows as the plain table and let the scan skip data."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from shopgrain.plans import layout
from shopgrain.sources.versions import VersionedTables

MONTH = date(1998, 11, 1)


@pytest.fixture(scope="module")
def laid_out(spark, shop, tmp_path_factory):
    tables = VersionedTables(spark, str(tmp_path_factory.mktemp("layout")), layout.LAYOUT_DDL)
    return {name: layout.write_layout(shop, tables, name) for name in layout.LAYOUTS}


def spread(spark, shop, tmp_path, name):
    """The layout as several files, which these few rows would not fill."""
    tables = VersionedTables(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return layout.write_layout(shop, tables, name)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def files_that_may_hold(stored, column, low, high):
    """How many files the statistics of the column leave, and how many there are."""
    spans = stored.groupBy(F.input_file_name()).agg(
        F.min(column).alias("a"), F.max(column).alias("b")).collect()
    return sum(r.a < high and r.b >= low for r in spans), len(spans)


@pytest.mark.parametrize("name, column, filtered", [
    ("orders_by_date", "order_date", layout.orders_month_status),
    ("payments_by_date", "payment_date", layout.payments_in_month)])
def test_month_needs_few_files(spark, shop, tmp_path, name, column, filtered):
    stored = spread(spark, shop, tmp_path, name)
    fast = filtered(stored, MONTH)
    assert rows(fast) == rows(filtered(shop.table(layout.LAYOUTS[name][0]), MONTH))
    assert f"GreaterThanOrEqual({column}" in plan(fast)
    start = datetime(MONTH.year, MONTH.month, 1)
    few, all_files = files_that_may_hold(stored, column, start, start + timedelta(days=31))
    assert all_files > 4 and few <= 2


def test_product_filter_reaches_the_scan(shop, laid_out):
    fast = layout.product_sales_point(laid_out["items_by_product"], 42)
    assert rows(fast) == rows(layout.product_sales_point(shop.order_items, 42))
    assert "EqualTo(product_id,42)" in plan(fast)
    assert "ReadSchema: struct<product_id:bigint,subtotal:decimal(12,2)>" in plan(fast)


def test_product_files_cover_disjoint_ranges(spark, shop, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = layout.write_layout(shop, tables, "items_by_product")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = sorted((r.low, r.high) for r in files.groupBy(F.input_file_name()).agg(
        F.min("product_id").alias("low"), F.max("product_id").alias("high")).collect())
    assert len(spans) > 1
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_status_folder(shop, laid_out):
    fast = layout.returned_orders(laid_out["orders_by_status"])
    assert rows(fast) == rows(layout.returned_orders(shop.orders))
    assert "order_status#" in plan(fast).split("PartitionFilters")[1].split("\n")[0]


def test_carrier_copy_is_narrow(shop, laid_out):
    narrow = laid_out["shipments_by_carrier"]
    assert narrow.columns == ["carrier", "tracking_number", "shipment_status"]
    fast = layout.carrier_shipments(narrow, "Carrier D")
    assert rows(fast) == rows(layout.carrier_shipments(shop.shipments, "Carrier D"))
    assert "EqualTo(carrier,Carrier D)" in plan(fast)


def test_folded_email_is_a_plain_comparison(shop, laid_out):
    email = "CUSTOMER#000000042@Example.com"
    fast = layout.user_by_email_ci(laid_out["users_by_email"], email)
    assert rows(fast) == rows(layout.user_by_email_ci(shop.users, email))
    assert len(rows(fast)) == 1
    assert "EqualTo(email_lc,customer#000000042@example.com)" in plan(fast)


def test_month_range_is_pushed_and_the_function_is_not(spark, shop, tmp_path):
    shop.payments.write.parquet(str(tmp_path / "p"))
    payments = spark.read.parquet(str(tmp_path / "p"))
    ranged = layout.payments_in_month(payments, MONTH)
    computed = layout.payments_in_month_by_function(payments, MONTH)
    assert rows(ranged) == rows(computed)
    assert "GreaterThanOrEqual(payment_date" in plan(ranged)
    assert "GreaterThanOrEqual(payment_date" not in plan(computed)


def test_year_end_month(spark):
    from shopgrain.functions import in_month

    df = spark.sql("""SELECT * FROM VALUES (TIMESTAMP_NTZ'1998-12-01 00:00:00'),
        (TIMESTAMP_NTZ'1998-12-31 23:59:59.999999'), (TIMESTAMP_NTZ'1999-01-01 00:00:00')
        AS t(c)""")
    assert df.where(in_month(F.col("c"), date(1998, 12, 15))).count() == 2
