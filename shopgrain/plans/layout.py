"""Data layouts that make selective filters cheap, and the filters that use them.

Where a row store adds an index, a Parquet table is written so that a filter skips folders, files
or row groups: partition folders for coarse columns, range-sorted files for keys and times, a narrow copy
for a covering read. A layout function returns the rows as they should be written; `write_layout`
stores them. No layout puts all rows of one value in one task: value folders are rebalanced, which
splits a large value over several files, and sorted files are cut on the value plus a unique key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import in_month
from shopgrain.sources.schemas import SHOP_DDL
from shopgrain.sources.tables import Shop
from shopgrain.sources.versions import VersionedTables


def orders_by_date(orders: DataFrame) -> DataFrame:
    """Files that each cover a narrow range of days; a busy day spans several."""
    return orders.repartitionByRange("order_date", "order_id").sortWithinPartitions(
        "order_date", "order_id"
    )


def payments_by_date(payments: DataFrame) -> DataFrame:
    """Files that each cover a narrow range of days."""
    return payments.repartitionByRange("payment_date", "payment_id").sortWithinPartitions(
        "payment_date", "payment_id"
    )


def items_by_product(order_items: DataFrame) -> DataFrame:
    """Files that each cover a narrow range of products."""
    return order_items.repartitionByRange("product_id", "item_id").sortWithinPartitions(
        "product_id", "item_id"
    )


def orders_by_status(orders: DataFrame) -> DataFrame:
    """For a folder per status."""
    return orders.hint("rebalance", "order_status").sortWithinPartitions(
        "order_status", "order_id"
    )


def shipments_by_carrier(shipments: DataFrame) -> DataFrame:
    """Only the columns the carrier lookup returns, range-sorted by carrier."""
    return (
        shipments.select("carrier", "tracking_number", "shipment_status")
        .repartitionByRange("carrier", "tracking_number")
        .sortWithinPartitions("carrier", "tracking_number")
    )


def users_by_email(users: DataFrame) -> DataFrame:
    """The case-folded address as a stored, sorted column."""
    return (
        users.withColumn("email_lc", F.lower("email"))
        .repartitionByRange("email_lc").sortWithinPartitions("email_lc")
    )


# Layout name -> (source table, layout, folder column).
LAYOUTS = {
    "orders_by_date": ("orders", orders_by_date, None),
    "payments_by_date": ("payments", payments_by_date, None),
    "items_by_product": ("order_items", items_by_product, None),
    "orders_by_status": ("orders", orders_by_status, "order_status"),
    "shipments_by_carrier": ("shipments", shipments_by_carrier, None),
    "users_by_email": ("users", users_by_email, None),
}

# Layout name -> DDL of the stored table.
LAYOUT_DDL = {
    "orders_by_date": SHOP_DDL["orders"],
    "payments_by_date": SHOP_DDL["payments"],
    "items_by_product": SHOP_DDL["order_items"],
    "orders_by_status": SHOP_DDL["orders"],
    "shipments_by_carrier": "carrier STRING, tracking_number STRING, shipment_status STRING",
    "users_by_email": SHOP_DDL["users"] + ", email_lc STRING",
}


def write_layout(shop: Shop, tables: VersionedTables, name: str) -> DataFrame:
    source, layout, folder = LAYOUTS[name]
    return tables.write(name, layout(shop.table(source)), folder)


# --- the filters -----------------------------------------------------------------------------


def orders_month_status(
    orders: DataFrame, month: date, status: str = "completed"
) -> DataFrame:
    """Orders of one month and status; on `orders_by_date` other files and row groups are skipped."""
    wanted = in_month(F.col("order_date"), month) & (F.col("order_status") == status)
    return orders.where(wanted).select("order_id", "user_id", "total_amount", "order_date")


def product_sales_point(order_items: DataFrame, product_id: int) -> DataFrame:
    """Sales of one product; on `items_by_product` other row groups are skipped."""
    return (
        order_items.where(F.col("product_id") == product_id)
        .groupBy("product_id").agg(F.sum("subtotal").alias("total_sales"))
    )


def payments_in_month(payments: DataFrame, month: date) -> DataFrame:
    """Payments of one month as a range on the stored column, which reaches the scan.

    On `payments_by_date` other files and row groups are skipped.
    """
    return payments.where(in_month(F.col("payment_date"), month)).agg(
        F.count(F.lit(1)).alias("payments")
    )


def payments_in_month_by_function(payments: DataFrame, month: date) -> DataFrame:
    """The same count with a function on the column: every row is read and computed."""
    first = F.lit(str(month.replace(day=1))).cast("date")
    return payments.where(F.trunc("payment_date", "month") == first).agg(
        F.count(F.lit(1)).alias("payments")
    )


def returned_orders(orders: DataFrame) -> DataFrame:
    """Orders of a rare status; on `orders_by_status` only its folder is read."""
    return orders.where(F.col("order_status") == "returned").select(
        "order_id", "user_id", "total_amount"
    )


def carrier_shipments(shipments: DataFrame, carrier: str) -> DataFrame:
    return shipments.where(F.col("carrier") == carrier).select(
        "tracking_number", "carrier", "shipment_status"
    )


def payments_successful(payments: DataFrame) -> DataFrame:
    """Nearly all rows pass, so no layout would help: the control case."""
    return payments.where(F.col("payment_status") == "successful")


def user_by_email_ci(users: DataFrame, email: str) -> DataFrame:
    """Users with this address in any case; on `users_by_email` a plain column comparison."""
    folded = F.col("email_lc") if "email_lc" in users.columns else F.lower("email")
    return users.where(folded == email.lower()).select(
        "user_id", "email", "full_name", "phone", "city", "created_at"
    )
