"""Schemas and write-time rules of the shop tables and of the star tables.

Parquet enforces none of the rules; `plans.audits` turns them into audit jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Table -> DDL.
SHOP_DDL = {
    "users": "user_id BIGINT, email STRING, full_name STRING, phone STRING, city STRING, "
             "created_at TIMESTAMP_NTZ",
    "categories": "category_id INT, name STRING, slug STRING",
    "products": "product_id BIGINT, category_id INT, sku STRING, name STRING, "
                "price DECIMAL(10,2), cost DECIMAL(10,2), created_at TIMESTAMP_NTZ",
    "coupons": "coupon_id BIGINT, code STRING, discount_pct DECIMAL(5,2), "
               "max_discount_amount DECIMAL(10,2), valid_from TIMESTAMP_NTZ, "
               "valid_to TIMESTAMP_NTZ",
    "orders": "order_id BIGINT, user_id BIGINT, coupon_id BIGINT, order_status STRING, "
              "total_amount DECIMAL(12,2), discount_amount DECIMAL(10,2), "
              "order_date TIMESTAMP_NTZ",
    "order_items": "item_id STRING, order_id BIGINT, product_id BIGINT, quantity INT, "
                   "unit_price DECIMAL(10,2), subtotal DECIMAL(12,2)",
    "payments": "payment_id BIGINT, order_id BIGINT, payment_method STRING, "
                "payment_status STRING, amount DECIMAL(12,2), payment_date TIMESTAMP_NTZ",
    "shipments": "shipment_id BIGINT, order_id BIGINT, tracking_number STRING, carrier STRING, "
                 "shipment_status STRING, shipped_at TIMESTAMP_NTZ, delivered_at TIMESTAMP_NTZ",
    "reviews": "review_id BIGINT, user_id BIGINT, product_id BIGINT, rating INT, "
               "comment STRING, created_at TIMESTAMP_NTZ",
    "inventory_movements": "movement_id BIGINT, product_id BIGINT, movement_type STRING, "
                           "quantity INT, reference_reason STRING, created_at TIMESTAMP_NTZ",
}

# Star table -> DDL. `order_month` serves month filters.
STAR_DDL = {
    "dim_date": "date_id INT, full_date DATE, year INT, quarter INT, month INT, "
                "month_name STRING, day INT, day_name STRING, is_weekend BOOLEAN",
    "dim_product": "product_key BIGINT, product_id BIGINT, sku STRING, product_name STRING, "
                   "category_name STRING, unit_cost DECIMAL(10,2), unit_price DECIMAL(10,2)",
    "dim_customer": "customer_key BIGINT, user_id BIGINT, email STRING, full_name STRING, "
                    "city STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, "
                    "is_current BOOLEAN",
    "fct_orders": "order_key BIGINT, order_id BIGINT, customer_key BIGINT, order_date_id INT, "
                  "order_status STRING, total_amount DECIMAL(12,2), "
                  "discount_amount DECIMAL(10,2), delivery_days INT, order_month INT",
    "fct_order_items": "order_item_key STRING, order_id BIGINT, order_date_id INT, "
                       "customer_key BIGINT, product_key BIGINT, quantity BIGINT, "
                       "unit_price DECIMAL(10,2), cost_amount DECIMAL(12,2), "
                       "subtotal DECIMAL(12,2), gross_margin DECIMAL(12,2), order_month INT",
}

# Primary keys and UNIQUE columns.
UNIQUE_KEYS = {
    "users": [("user_id",), ("email",)],
    "categories": [("category_id",), ("name",), ("slug",)],
    "products": [("product_id",), ("sku",)],
    "coupons": [("coupon_id",), ("code",)],
    "orders": [("order_id",)],
    "order_items": [("item_id",)],
    "payments": [("payment_id",)],
    "shipments": [("shipment_id",), ("tracking_number",)],
    "reviews": [("review_id",)],
    "inventory_movements": [("movement_id",)],
}

# Columns that may hold NULL; all others are NOT NULL.
NULLABLE = {
    "users": {"phone", "city"},
    "orders": {"coupon_id"},
    "shipments": {"delivered_at"},
    "reviews": {"comment"},
}


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_column: str
    on_delete: str  # cascade, set null or restrict


# References between the shop tables.
FOREIGN_KEYS = [
    ForeignKey("products", "category_id", "categories", "category_id", "restrict"),
    ForeignKey("orders", "user_id", "users", "user_id", "cascade"),
    ForeignKey("orders", "coupon_id", "coupons", "coupon_id", "set null"),
    ForeignKey("order_items", "order_id", "orders", "order_id", "cascade"),
    ForeignKey("order_items", "product_id", "products", "product_id", "restrict"),
    ForeignKey("payments", "order_id", "orders", "order_id", "cascade"),
    ForeignKey("shipments", "order_id", "orders", "order_id", "cascade"),
    ForeignKey("reviews", "user_id", "users", "user_id", "cascade"),
    ForeignKey("reviews", "product_id", "products", "product_id", "cascade"),
    ForeignKey("inventory_movements", "product_id", "products", "product_id", "restrict"),
]

# CHECK rules on single rows. A NULL outcome passes, as in SQL.
DOMAINS = {
    "products": ["price >= 0", "cost >= 0"],
    "coupons": ["discount_pct > 0 AND discount_pct <= 100", "max_discount_amount >= 0"],
    "orders": ["order_status IN ('pending', 'completed', 'cancelled', 'returned')",
               "total_amount >= 0", "discount_amount >= 0"],
    "order_items": ["quantity > 0", "unit_price >= 0", "subtotal >= 0"],
    "payments": ["payment_method IN ('credit_card', 'bank_transfer', 'gift_card')",
                 "payment_status IN ('successful', 'failed', 'refunded')", "amount >= 0"],
    "shipments": ["shipment_status IN ('shipped', 'in_transit', 'delivered', 'failed')"],
    "reviews": ["rating BETWEEN 1 AND 5"],
    "inventory_movements": ["movement_type IN ('IN', 'OUT')", "quantity > 0"],
}

# Rules that compare two columns of a row.
CROSS_COLUMN = {
    "coupons": ["valid_to >= valid_from"],
    "shipments": ["delivered_at >= shipped_at"],
}


# The keys, references and nullable columns of the star.
STAR_UNIQUE_KEYS = {
    "dim_date": [("date_id",), ("full_date",)],
    "dim_customer": [("customer_key",)],
    "dim_product": [("product_key",), ("product_id",)],
    "fct_orders": [("order_key",), ("order_id",)],
    "fct_order_items": [("order_item_key",), ("order_id", "product_key")],
}
STAR_FOREIGN_KEYS = [
    ForeignKey("fct_orders", "customer_key", "dim_customer", "customer_key", "restrict"),
    ForeignKey("fct_orders", "order_date_id", "dim_date", "date_id", "restrict"),
    ForeignKey("fct_order_items", "order_date_id", "dim_date", "date_id", "restrict"),
    ForeignKey("fct_order_items", "customer_key", "dim_customer", "customer_key", "restrict"),
    ForeignKey("fct_order_items", "product_key", "dim_product", "product_key", "restrict"),
]
STAR_NULLABLE = {"dim_customer": {"city", "valid_to"}, "fct_orders": {"delivery_days"}}


@dataclass(frozen=True)
class Rules:
    """The rule set an audit run works on; the defaults are the shop's own."""

    unique: dict = field(default_factory=lambda: UNIQUE_KEYS)
    nullable: dict = field(default_factory=lambda: NULLABLE)
    foreign_keys: list = field(default_factory=lambda: FOREIGN_KEYS)
    domains: dict = field(default_factory=lambda: DOMAINS)
    cross_column: dict = field(default_factory=lambda: CROSS_COLUMN)
