"""Profiles of how the data is distributed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.functions import pct
from shopgrain.operators.positions import rows_at
from shopgrain.session import materialise


def profile_nulls(users: DataFrame, columns: tuple[str, ...] = ("phone", "city")) -> DataFrame:
    """Share of users without each contact column, in one pass."""
    total = F.count(F.lit(1))
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), total.alias("row_count"),
                 F.count_if(F.col(c).isNull()).alias("null_count"))
        for c in columns
    ])
    return (
        users.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*")
        .withColumn("null_pct", pct(F.col("null_count"), F.col("row_count")))
    )


def profile_pareto(order_items: DataFrame, share: float = 0.2) -> DataFrame:
    """Share of units sold by the best-selling `share` of the products that sold.

    Products are ranked by units, then product_id. The rank border is found by counting, so no
    task sorts all products; the per-product totals are written once as several passes read them.
    """
    units = materialise(
        order_items.groupBy("product_id")
        .agg(F.sum("quantity").cast("bigint").alias("units"))
        .withColumn("_fewer", -F.col("units")),
        "pareto",
    )
    borders = rows_at(
        units, ["_fewer", "product_id"], lambda n: [int(n * share)] if n * share >= 1 else []
    )
    in_top = F.lit(False)
    for fewer, product in borders.values():
        in_top = (F.col("_fewer") < fewer) | (
            (F.col("_fewer") == fewer) & (F.col("product_id") <= product)
        )
    total = F.sum("units")
    top = F.sum(F.when(in_top, F.col("units")).otherwise(0))
    return units.agg(
        F.count(F.lit(1)).alias("products"), F.count_if(in_top).alias("top_products"),
        total.alias("units"), top.alias("top_units"), pct(top, total).alias("top_units_pct"),
    )


def profile_seasonality(orders: DataFrame) -> DataFrame:
    """Orders and their share per day of the year."""
    days = orders.groupBy(F.dayofyear("order_date").alias("day_of_year")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    # At most 366 rows are left, so the share over all of them is a small window.
    everything = F.sum("orders").over(W.partitionBy())
    return days.withColumn("orders_pct", pct(F.col("orders"), everything))


def profile_mix(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """How rows divide over order status, payment method and rating."""
    def mix(df: DataFrame, column: str) -> DataFrame:
        return df.groupBy(F.col(column).cast("string").alias("value")).agg(
            F.count(F.lit(1)).alias("row_count")
        ).select(F.lit(column).alias("column_name"), "value", "row_count")

    parts = reduce(DataFrame.unionByName, [
        mix(orders, "order_status"), mix(payments, "payment_method"), mix(reviews, "rating"),
    ])
    total = F.sum("row_count").over(W.partitionBy("column_name"))
    return parts.withColumn("row_pct", pct(F.col("row_count"), total))
