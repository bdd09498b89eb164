"""The given order-system tables seen as shop tables.

Every role is one projection over one given table (plus a row-wise filter where a role is a kind
of event), so no role adds a join or a shuffle to the question that reads it. The expressions are
plain SQL that other engines read the same way; `{ts}` stands for the timestamp literal prefix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shopgrain.sources.tables import Shop


@dataclass(frozen=True)
class Role:
    source: str
    columns: dict[str, str]
    where: str | None = None
    distinct: bool = False


# Columns of the given tables. Naming them spares a footer-reading job per scan.
SOURCE_DDL = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}

_STATUS = ("CASE WHEN o_orderkey % 101 < 91 THEN 'completed' WHEN o_orderkey % 101 < 93 THEN "
           "'returned' WHEN o_orderkey % 101 < 98 THEN 'pending' ELSE 'cancelled' END")
_ORDER_TS = "o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR"
_TO_SHIP = "o_orderkey % 24 + 12 + o_orderkey % 36"
_TRAVEL = "24 * (CASE WHEN o_orderkey % 200 = 3 THEN -1 ELSE 1 + o_orderkey % 3 END)"


def _money(cents: str, precision: int) -> str:
    """Whole cents as a decimal; far cheaper per row than casting a double to decimal."""
    return f"CAST(CAST({cents} AS DECIMAL({precision},0)) * 0.01 AS DECIMAL({precision},2))"


_UNIT_CENTS = "CAST(floor(l_extendedprice * 2 + 0.5) AS BIGINT)"
_TOTAL = _money("CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)", 12)
_PRICE = _money("CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT)", 10)
_COST = _money("CAST(floor(p_retailprice * (40 + p_partkey % 45) + 0.5) AS BIGINT)", 10)
_PICKUP_SECOND = "60 * (l_orderkey % 1440) + l_partkey % 60"
_RIDE_SECONDS = "60 * (l_partkey % 130) + l_suppkey % 60"

ROLES = {
    # One customer in fifty never orders: the orders role gives their orders to a neighbour.
    "users": Role("customer", {
        "user_id": "c_custkey",
        "email": "concat(c_name, '@example.com')",
        "full_name": "c_name",
        "phone": "CASE WHEN c_custkey % 20 = 11 THEN NULL "
                 "ELSE concat('+90-', CAST(c_custkey AS VARCHAR(20))) END",
        "city": "CASE WHEN c_custkey % 20 = 7 THEN NULL "
                "ELSE concat('City ', CAST(c_nationkey AS VARCHAR(20))) END",
        "created_at": "{ts}'1994-01-01 00:00:00' + (c_custkey % 365) * INTERVAL '1' DAY",
    }),
    "categories": Role("part", {
        "category_id": "CAST(substr(p_brand, 7) AS INT)",
        "name": "p_brand",
        "slug": "lower(replace(p_brand, '#', '-'))",
    }, distinct=True),
    "products": Role("part", {
        "product_id": "p_partkey",
        "category_id": "CAST(substr(p_brand, 7) AS INT)",
        "sku": "concat('SKU-', CAST(p_partkey AS VARCHAR(20)))",
        "name": "concat(p_name, ' ', CAST(p_partkey AS VARCHAR(20)))",
        "price": _PRICE,
        "cost": _COST,
        "created_at": "{ts}'1994-01-01 00:00:00'",
    }),
    "coupons": Role("nation", {
        "coupon_id": "CAST(n_nationkey AS BIGINT)",
        "code": "concat('PROMO-', n_name)",
        "discount_pct": "CAST(5 + 5 * (n_nationkey % 5) AS DECIMAL(5,2))",
        "max_discount_amount": "CAST(100 + 200 * (n_nationkey % 3) AS DECIMAL(10,2))",
        "valid_from": "{ts}'1995-01-01 00:00:00'",
        "valid_to": "{ts}'2001-12-31 00:00:00'",
    }),
    "orders": Role("orders", {
        "order_id": "o_orderkey",
        "user_id": "CASE WHEN o_custkey % 50 = 49 THEN o_custkey - 1 ELSE o_custkey END",
        "coupon_id": "CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 23 END",
        "order_status": _STATUS,
        "total_amount": _TOTAL,
        "discount_amount": "CAST(0 AS DECIMAL(10,2))",
        "order_date": _ORDER_TS,
    }),
    "order_items": Role("lineitem", {
        "item_id": "concat(CAST(l_orderkey AS VARCHAR(20)), '-', "
                   "CAST(l_linenumber AS VARCHAR(20)), '-', CAST(l_partkey AS VARCHAR(20)), '-', "
                   "CAST(l_suppkey AS VARCHAR(20)))",
        "order_id": "l_orderkey",
        "product_id": "l_partkey",
        "quantity": "CAST(l_quantity AS INT)",
        "unit_price": _money(_UNIT_CENTS, 10),
        "subtotal": _money(f"{_UNIT_CENTS} * CAST(l_quantity AS BIGINT)", 12),
    }),
    "payments": Role("orders", {
        "payment_id": "o_orderkey",
        "order_id": "o_orderkey",
        "payment_method": "CASE WHEN o_orderkey % 20 < 17 THEN 'credit_card' "
                          "WHEN o_orderkey % 20 < 19 THEN 'bank_transfer' ELSE 'gift_card' END",
        "payment_status": f"CASE WHEN {_STATUS} IN ('completed', 'returned') "
                          "THEN 'successful' ELSE 'failed' END",
        "amount": _TOTAL,
        "payment_date": "o_orderdate + (60 * (o_orderkey % 24) + 1 + o_orderkey % 44) "
                        "* INTERVAL '1' MINUTE",
    }),
    "shipments": Role("orders", {
        "shipment_id": "o_orderkey * 2",
        "order_id": "o_orderkey",
        "tracking_number": "concat('TRK-', CAST(o_orderkey AS VARCHAR(20)))",
        "carrier": "CASE o_orderkey % 4 WHEN 0 THEN 'Carrier A' WHEN 1 THEN 'Carrier B' "
                   "WHEN 2 THEN 'Carrier C' ELSE 'Carrier D' END",
        "shipment_status": "'delivered'",
        "shipped_at": f"o_orderdate + ({_TO_SHIP}) * INTERVAL '1' HOUR",
        "delivered_at": f"o_orderdate + ({_TO_SHIP} + {_TRAVEL}) * INTERVAL '1' HOUR",
    }, where=f"{_STATUS} IN ('completed', 'returned')"),
    "reviews": Role("events", {
        "review_id": "event_id",
        "user_id": "user_id",
        "product_id": "event_id % 50",
        "rating": "CAST(1 + CAST(floor(value) AS INT) % 5 AS INT)",
        "comment": "CASE WHEN user_id % 10 < 3 THEN NULL ELSE props END",
        "created_at": "ts",
    }, where="event_type = 'view'"),
    "inventory_movements": Role("events", {
        "movement_id": "event_id",
        "product_id": "event_id % 180",
        "movement_type": "CASE WHEN user_id % 10 < 3 THEN 'IN' ELSE 'OUT' END",
        "quantity": "CAST(1 + event_id % 49 AS INT)",
        "reference_reason": "CASE event_id % 7 % 4 WHEN 0 THEN 'PO_PURCHASE' "
                            "WHEN 1 THEN 'ORDER_FULFILLMENT' WHEN 2 THEN 'RETURN_RESTOCK' "
                            "ELSE 'DAMAGED_SCRAP' END",
        "created_at": "ts",
    }, where="event_type IN ('purchase', 'click')"),
}

# The second parcel of an urgent, large order: still on its way, so it has no delivery time.
SECOND_PARCELS = Role("orders", {
    "shipment_id": "o_orderkey * 2 + 1",
    "order_id": "o_orderkey",
    "tracking_number": "concat('TRK2-', CAST(o_orderkey AS VARCHAR(20)))",
    "carrier": "'Carrier A'",
    "shipment_status": "'in_transit'",
    "shipped_at": "o_orderdate + (o_orderkey % 24 + 60) * INTERVAL '1' HOUR",
    "delivered_at": "CAST(NULL AS TIMESTAMP)",
}, where=f"{_STATUS} = 'completed' AND o_orderpriority = '1-URGENT' AND o_totalprice > 490000")

TRIPS = Role("lineitem", {
    "passenger_count": "CASE WHEN l_orderkey % 31 = 4 THEN NULL ELSE l_linenumber END",
    "trip_distance": "l_quantity",
    "payment_type": "CAST(1 + l_orderkey % 4 AS INT)",
    "pu_location_id": "l_suppkey % 20",
    "do_location_id": "l_partkey % 20",
    "total_amount": "CASE WHEN l_orderkey % 100 = 3 THEN -l_extendedprice "
                    "WHEN l_orderkey % 100 = 4 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END",
    "tip_amount": "l_extendedprice * l_tax",
    "airport_fee": "CASE WHEN l_suppkey % 10 = 1 THEN CAST(1.75 AS DOUBLE) "
                   "ELSE CAST(0 AS DOUBLE) END",
    "pickup_at": f"l_shipdate + ({_PICKUP_SECOND}) * INTERVAL '1' SECOND",
    "dropoff_at": f"l_shipdate + (CASE WHEN l_orderkey % 211 = 9 THEN NULL "
                  f"ELSE {_PICKUP_SECOND} + {_RIDE_SECONDS} END) * INTERVAL '1' SECOND",
})


def role_frame(spark: SparkSession, folder: str, role: Role) -> DataFrame:
    df = spark.read.schema(SOURCE_DDL[role.source]).parquet(f"{folder}/{role.source}.parquet")
    if role.where:
        df = df.where(role.where)
    ntz = {"{ts}": "TIMESTAMP_NTZ", "AS TIMESTAMP)": "AS TIMESTAMP_NTZ)"}
    exprs = []
    for name, text in role.columns.items():
        for ours, theirs in ntz.items():
            text = text.replace(ours, theirs)
        exprs.append(f"{text} AS {name}")
    df = df.selectExpr(*exprs)
    return df.distinct() if role.distinct else df


def role_shop(spark: SparkSession, folder: str) -> Shop:
    def load(name: str) -> DataFrame:
        df = role_frame(spark, folder, ROLES[name])
        if name == "shipments":
            df = df.unionByName(role_frame(spark, folder, SECOND_PARCELS))
        return df

    return Shop(load)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return role_frame(spark, folder, TRIPS)
