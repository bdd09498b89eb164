"""Ten questions in two forms: on the shop tables and on the star.

Both forms give the same numbers except where the star keeps history (`city_revenue_hist`), works
per customer version (`top_spenders`), or merges repeated lines (`category_items`). Facts are
summed per customer or product before that dimension is joined on, so a frequent one is one row by
then. Orders are summed per month before the calendar is joined on, and the calendar is left out
where the date id itself tells the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import is_weekend, mean, month_start, round2, whole_days
from shopgrain.operators.joins import label_null
from shopgrain.plans.questions import DONE, UNKNOWN_CITY, product_sales


def _count(alias: str):
    return F.count(F.lit(1)).alias(alias)


def _revenue():
    return F.sum("total_amount").alias("revenue")


def _items_of_done_orders(fct_order_items: DataFrame, fct_orders: DataFrame) -> DataFrame:
    done = fct_orders.where(DONE).select("order_id")
    return fct_order_items.join(done, "order_id", "left_semi")


def monthly_revenue_oltp(orders: DataFrame) -> DataFrame:
    return orders.where(DONE).groupBy(month_start(F.col("order_date")).alias("month")).agg(
        _revenue()
    )


def _per_month(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.where(DONE).groupBy("order_month").agg(_revenue())


def monthly_revenue_star(fct_orders: DataFrame) -> DataFrame:
    """Year and month are digits of the month number; no calendar is needed."""
    return _per_month(fct_orders).select(
        F.expr("order_month div 100").cast("int").alias("year"),
        (F.col("order_month") % 100).alias("month"), "revenue")


def monthly_revenue_named_star(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """With the month's name, from the calendar's first days of months."""
    months = dim_date.where("day = 1").select(
        F.expr("date_id div 100").cast("int").alias("order_month"), "year", "month_name")
    return _per_month(fct_orders).join(months, "order_month").select("year", "month_name", "revenue")


def category_margin_oltp(
    order_items: DataFrame, products: DataFrame, categories: DataFrame, orders: DataFrame
) -> DataFrame:
    margin = F.col("revenue") - F.col("units") * F.col("cost")
    names = categories.select("category_id", F.col("name").alias("category_name"))
    return (
        product_sales(order_items, orders)
        .join(products.select("product_id", "category_id", "cost"), "product_id")
        .groupBy("category_id").agg(F.sum(margin).alias("margin"))
        .join(names, "category_id")
        .groupBy("category_name").agg(F.sum("margin").alias("gross_margin"))
    )


def category_margin_star(
    fct_order_items: DataFrame, dim_product: DataFrame, fct_orders: DataFrame
) -> DataFrame:
    per_product = _items_of_done_orders(fct_order_items, fct_orders).groupBy("product_key").agg(
        F.sum("gross_margin").alias("margin")
    )
    return (
        per_product.join(dim_product.select("product_key", "category_name"), "product_key")
        .groupBy("category_name").agg(F.sum("margin").alias("gross_margin"))
    )


def _day_type(weekend):
    return F.when(weekend, "Weekend").otherwise("Weekday").alias("day_type")


def weekend_split_oltp(orders: DataFrame) -> DataFrame:
    return orders.where(DONE).groupBy(_day_type(is_weekend(F.col("order_date")))).agg(
        _count("orders"), _revenue()
    )


def weekend_split_star(fct_orders: DataFrame) -> DataFrame:
    """The weekday follows from the date id."""
    day = F.col("order_date_id")
    date = F.make_date(F.expr("order_date_id div 10000").cast("int"),
                       F.expr("order_date_id div 100 % 100").cast("int"), day % 100)
    return fct_orders.where(DONE).groupBy(_day_type(is_weekend(date))).agg(
        _count("orders"), _revenue())


def city_revenue_hist_oltp(users: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    """Revenue by the city customers live in now."""
    per_user = orders.where(DONE).groupBy("user_id").agg(_revenue())
    return (
        users.select("user_id", label_null(F.col("city"), UNKNOWN_CITY).alias("city"))
        .join(per_user, "user_id")
        .groupBy("city").agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_first(), "city").limit(k)
    )


def city_revenue_hist_star(
    fct_orders: DataFrame, dim_customer: DataFrame, k: int = 10
) -> DataFrame:
    """Revenue by the city customers lived in when they ordered."""
    per_version = fct_orders.where(DONE).groupBy("customer_key").agg(_revenue())
    return (
        per_version.join(dim_customer.select("customer_key", "city"), "customer_key")
        .groupBy("city").agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_first(), "city").limit(k)
    )


def top5_units_oltp(
    order_items: DataFrame, products: DataFrame, orders: DataFrame, k: int = 5
) -> DataFrame:
    names = products.select("product_id", F.col("name").alias("product_name"))
    return (
        product_sales(order_items, orders).join(names, "product_id")
        .groupBy("product_name").agg(F.sum("units").alias("units"))
        .orderBy(F.col("units").desc(), "product_name").limit(k)
    )


def top5_units_star(
    fct_order_items: DataFrame, dim_product: DataFrame, fct_orders: DataFrame, k: int = 5
) -> DataFrame:
    per_product = _items_of_done_orders(fct_order_items, fct_orders).groupBy("product_key").agg(
        F.sum("quantity").alias("n")
    )
    return (
        per_product.join(dim_product.select("product_key", "product_name"), "product_key")
        .groupBy("product_name").agg(F.sum("n").alias("units"))
        .orderBy(F.col("units").desc(), "product_name").limit(k)
    )


def avg_delivery_oltp(shipments: DataFrame) -> DataFrame:
    days = whole_days(F.col("shipped_at"), F.col("delivered_at"))
    return shipments.where(F.col("delivered_at") >= F.col("shipped_at")).agg(
        round2(mean(days)).alias("avg_delivery_days")
    )


def avg_delivery_star(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.where(F.col("delivery_days").isNotNull()).agg(
        round2(mean(F.col("delivery_days"))).alias("avg_delivery_days")
    )


def quarterly_revenue_oltp(orders: DataFrame) -> DataFrame:
    return orders.where(DONE).groupBy(
        F.year("order_date").alias("year"), F.quarter("order_date").alias("quarter")
    ).agg(_revenue())


def quarterly_revenue_star(fct_orders: DataFrame) -> DataFrame:
    quarter = F.expr("(order_month % 100 + 2) div 3").cast("int")
    return _per_month(fct_orders).groupBy(
        F.expr("order_month div 100").cast("int").alias("year"), quarter.alias("quarter")
    ).agg(F.sum("revenue").alias("revenue"))


def aov_oltp(orders: DataFrame) -> DataFrame:
    return orders.where(DONE).agg(
        round2(mean(F.col("total_amount"))).alias("average_order_value")
    )


def aov_star(fct_orders: DataFrame) -> DataFrame:
    return aov_oltp(fct_orders)


def top_spenders_oltp(orders: DataFrame, k: int = 10) -> DataFrame:
    return (
        orders.where(DONE).groupBy("user_id").agg(_revenue())
        .orderBy(F.col("revenue").desc(), "user_id").limit(k)
    )


def top_spenders_star(fct_orders: DataFrame, k: int = 10) -> DataFrame:
    """Per customer version: a customer who moved appears once for each place."""
    return (
        fct_orders.where(DONE).groupBy("customer_key").agg(_revenue())
        .orderBy(F.col("revenue").desc(), "customer_key").limit(k)
    )


def top_spenders_star_by_user(
    fct_orders: DataFrame, dim_customer: DataFrame, k: int = 10
) -> DataFrame:
    """Per customer over all versions, which agrees with the form on the shop tables."""
    per_version = fct_orders.where(DONE).groupBy("customer_key").agg(
        F.sum("total_amount").alias("amount")
    )
    return (
        per_version.join(dim_customer.select("customer_key", "user_id"), "customer_key")
        .groupBy("user_id").agg(F.sum("amount").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "user_id").limit(k)
    )


def category_items_oltp(
    order_items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    names = categories.select("category_id", F.col("name").alias("category_name"))
    return (
        order_items.groupBy("product_id").agg(_count("n"))
        .join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id").agg(F.sum("n").alias("n"))
        .join(names, "category_id")
        .groupBy("category_name").agg(F.sum("n").alias("items"))
    )


def category_items_star(fct_order_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Counts merged lines, so it lies below the other form by the number of repeats."""
    return (
        fct_order_items.groupBy("product_key").agg(_count("n"))
        .join(dim_product.select("product_key", "category_name"), "product_key")
        .groupBy("category_name").agg(F.sum("n").alias("items"))
    )
