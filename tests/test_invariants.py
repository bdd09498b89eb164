"""Statements that must hold between different questions on the same tables."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shopgrain.plans import pairs, questions as q, star as s


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


@pytest.fixture(scope="module")
def synced(shop):
    """Orders that have lines, with their total set to the sum of the lines."""
    lines = shop.order_items.select("order_id").distinct()
    return s.sync_order_totals(shop.orders, shop.order_items).join(lines, "order_id", "left_semi")


def test_weekday_revenue_equals_coupon_revenue(shop, synced):
    weekdays = q.orders_by_weekday(synced)
    channels = q.coupon_margin(synced, shop.order_items, shop.products)
    assert total(weekdays, "total_revenue") == total(channels, "gross_revenue")
    assert total(weekdays, "total_orders") == total(channels, "order_count")


def test_successful_payments_equal_paid_orders(shop):
    paid = q.order_funnel(shop.orders, shop.payments, shop.shipments).first().paid_orders
    assert total(q.payment_success(shop.payments), "success_tx") == paid


def test_sane_and_broken_deliveries_add_up(shop):
    sane = total(q.carrier_delivery_days(shop.shipments), "total_shipments")
    broken = q.delivery_anomalies(shop.shipments).count()
    assert sane + broken == shop.shipments.where("shipment_status = 'delivered'").count()


def test_both_forms_agree(shop, star):
    f, p = star["fct_orders"], star["dim_product"]
    month = pairs.monthly_revenue_oltp(shop.orders).select(
        F.year("month").alias("year"), F.month("month").alias("month"), "revenue")
    assert rows(month) == rows(pairs.monthly_revenue_star(f))
    assert rows(pairs.weekend_split_oltp(shop.orders)) == rows(pairs.weekend_split_star(f))
    assert rows(pairs.quarterly_revenue_oltp(shop.orders)) \
        == rows(pairs.quarterly_revenue_star(f))
    assert rows(pairs.aov_oltp(shop.orders)) == rows(pairs.aov_star(f))
    assert rows(pairs.avg_delivery_oltp(shop.shipments)) == rows(pairs.avg_delivery_star(f))
    assert rows(pairs.top_spenders_oltp(shop.orders)) \
        == rows(pairs.top_spenders_star_by_user(f, star["dim_customer"]))
    items = star["fct_order_items"]
    assert rows(pairs.category_margin_oltp(
        shop.order_items, shop.products, shop.categories, shop.orders)) \
        == rows(pairs.category_margin_star(items, p, f))
    assert rows(pairs.top5_units_oltp(shop.order_items, shop.products, shop.orders)) \
        == rows(pairs.top5_units_star(items, p, f))


def test_merged_lines_explain_the_count_gap(shop, star):
    plain = total(pairs.category_items_oltp(
        shop.order_items, shop.products, shop.categories), "items")
    merged = total(pairs.category_items_star(
        star["fct_order_items"], star["dim_product"]), "items")
    repeats = shop.order_items.count() - shop.order_items.select(
        "order_id", "product_id").distinct().count()
    assert plain - merged == repeats > 0


def test_history_changes_city_revenue_but_not_its_sum(shop, star):
    now = pairs.city_revenue_hist_oltp(shop.users, shop.orders, k=1000)
    then = pairs.city_revenue_hist_star(star["fct_orders"], star["dim_customer"], k=1000)
    assert total(now, "revenue") == total(then, "revenue")
    assert rows(now) != rows(then)
