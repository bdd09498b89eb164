"""The star schema: dimensions, facts, their loads, and checks on both.

Every load step takes the tables it reads and the present state of its target, and returns the
full next state. Keys are computed from the row itself, so a rerun gives the same keys.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions import day_id, day_name, dow_sunday0, is_weekend, month_name, whole_days
from shopgrain.operators.joins import as_of_join, label_null
from shopgrain.operators.merge import (
    count_copies, held_apart, insert_if_absent, reject_counted, reject_duplicate_keys,
    replace_rows, row_diff, row_diff_by, update_from, upsert,
)
from shopgrain.operators.ranges import cut_by_range, range_count, range_starts
from shopgrain.plans.questions import UNKNOWN_CITY
from shopgrain.session import setting
from shopgrain.sources.schemas import STAR_DDL
from shopgrain.sources.tables import Shop
from shopgrain.sources.versions import VersionedTables

# customer_key = user_id * VERSION_SPACE + version number. Overflow raises, and so does a version
# number that leaves its user's range, so keys never collide and a user's history stays bounded.
VERSION_SPACE = 1 << 20
TRACKED = ["email", "full_name", "city"]
FIRST_SEEN = "created_at"
CUT = ("order_date_id", "order_id")  # what facts are cut into files by
CUT_ORDERS = 1 << 18  # orders, about, whose lines the bounds of files are taken from
# Shuffle files of a finished step go at once, not when the driver happens to collect garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# --- dimensions ------------------------------------------------------------------------------


def order_years(orders: DataFrame) -> DataFrame:
    """One row: first and last day of the calendar years that orders fall in."""
    first, last = F.min("order_date"), F.max("order_date")
    return orders.agg(
        F.trunc(first, "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc(last, "year"), 12), 1).alias("last_day"),
    )


def date_bounds(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row: a fixed calendar range."""
    return spark.range(1).select(
        F.lit(str(first)).cast("date").alias("first_day"),
        F.lit(str(last)).cast("date").alias("last_day"),
    )


def dim_date(bounds: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A calendar row per day of `bounds` (first_day, last_day), added where absent."""
    day = F.col("full_date")
    calendar = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    ).select(
        day_id(day).alias("date_id"), "full_date",
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        month_name(day).alias("month_name"), F.day(day).alias("day"),
        day_name(dow_sunday0(day)).alias("day_name"), is_weekend(day).alias("is_weekend"),
    )
    return calendar if existing is None else insert_if_absent(existing, calendar, ["date_id"])


def dim_product(
    products: DataFrame, categories: DataFrame, existing: DataFrame | None = None,
    update_cols: list[str] | None = None,
) -> DataFrame:
    """Products with their category name, overwritten in place (type 1)."""
    named = categories.select("category_id", F.col("name").alias("category_name"))
    rows = products.join(named, "category_id").select(
        F.col("product_id").alias("product_key"), "product_id", "sku",
        F.col("name").alias("product_name"), "category_name",
        F.col("cost").alias("unit_cost"), F.col("price").alias("unit_price"),
    )
    if existing is None:
        return rows
    return upsert(existing, rows, ["product_id"], update_cols)


def _open_version(key: Column, attributes: list[Column], since: Column) -> list[Column]:
    return [
        key.alias("customer_key"), F.col("user_id"), *attributes, since.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"),
    ]


def _first_key() -> Column:
    return F.col("user_id").cast("bigint") * VERSION_SPACE


def dim_customer(users: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One open version for each user the dimension has not seen."""
    city = label_null(F.col("city"), UNKNOWN_CITY).alias("city")
    unseen = users if existing is None else users.join(
        existing.select("user_id").distinct(), "user_id", "left_anti"
    )
    rows = unseen.select(*_open_version(
        _first_key(), [F.col("email"), F.col("full_name"), city], F.col(FIRST_SEEN)
    ))
    return rows if existing is None else existing.unionByName(rows)


def _changes(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Open versions beside the incoming row of the same user, from either side.

    incoming holds user_id, the tracked attributes and effective_at, one row per user.
    """
    old = dim.where(F.col("is_current")).select("user_id", F.struct(*dim.columns).alias("old"))
    city = label_null(F.col("city"), UNKNOWN_CITY).alias("city")
    new = reject_duplicate_keys(
        incoming.select("user_id", "email", "full_name", city, "effective_at"), ["user_id"]
    ).select("user_id", F.struct(*TRACKED, "effective_at").alias("new"))
    both = old.join(new, "user_id", "full")
    same = F.lit(True)
    for c in TRACKED:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    return both.withColumn(
        "differs", F.col("old").isNotNull() & F.col("new").isNotNull() & ~same
    ).withColumn("in_time", F.col("new.effective_at") > F.col("old.valid_from"))


def apply_customer_changes(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Type-2 step: close the open version where attributes differ, and open a new one.

    Equal attributes change nothing, so a rerun is harmless. Closed history is passed through
    without a shuffle. A change that does not lie after the start of the open version is left
    out here and listed by `rejected_customer_changes`.
    """
    columns = dim.columns
    attributes = [F.col(f"new.{c}").alias(c) for c in TRACKED]
    kept = F.struct(*[F.col(f"old.{c}").alias(c) for c in columns])
    closed = F.struct(*[
        {"valid_to": F.col("new.effective_at"), "is_current": F.lit(False)}
        .get(c, F.col(f"old.{c}")).alias(c) for c in columns
    ])
    next_key = F.col("old.customer_key") + 1
    next_key = F.when(next_key % VERSION_SPACE == 0, F.raise_error(
        F.concat(F.lit("too many versions of user "), F.col("user_id").cast("string"))
    ).cast("bigint")).otherwise(next_key)
    successor = F.struct(*_open_version(next_key, attributes, F.col("new.effective_at")))
    newcomer = F.struct(*_open_version(_first_key(), attributes, F.col("new.effective_at")))
    rows = (
        F.when(F.col("old").isNull(), F.array(newcomer))
        .when(F.col("differs") & F.col("in_time"), F.array(closed, successor))
        .otherwise(F.array(kept))
    )
    current = _changes(dim, incoming).select(F.explode(rows).alias("r")).select("r.*")
    return dim.where(~F.col("is_current")).unionByName(current.select(*columns))


def rejected_customer_changes(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Changes that came too late to be applied, for someone to look at."""
    reason = F.when(
        F.col("new.effective_at") == F.col("old.valid_from"), "same instant"
    ).otherwise("before open version")
    return _changes(dim, incoming).where(F.col("differs") & ~F.col("in_time")).select(
        "user_id", F.col("new.effective_at").alias("effective_at"),
        F.col("old.valid_from").alias("open_since"), reason.alias("reason"),
    )


def change_outcomes(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """What becomes of each change: the outcomes of a feed add up to its rows."""
    outcome = (
        F.when(F.col("new").isNull(), None)
        .when(F.col("old").isNull(), "new user")
        .when(~F.col("differs"), "unchanged")
        .when(F.col("in_time"), "applied")
        .otherwise("rejected")
    )
    return _changes(dim, incoming).groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("changes")).where("outcome IS NOT NULL")


# --- facts -----------------------------------------------------------------------------------


def delivery_by_order(shipments: DataFrame) -> DataFrame:
    """One row per order: days of its latest delivered parcel, NULL if the times contradict.

    Parcels still on their way count only for orders that have no delivered one.
    """
    newest = F.max(F.struct(
        F.col("delivered_at").isNotNull().alias("arrived"), "shipped_at", "shipment_id",
        "delivered_at",
    )).alias("p")
    sane = F.col("p.delivered_at") >= F.col("p.shipped_at")
    days = whole_days(F.col("p.shipped_at"), F.col("p.delivered_at")).cast("int")
    return shipments.groupBy("order_id").agg(newest).select(
        "order_id", F.when(sane, days).alias("delivery_days")
    )


def _month(day: Column) -> Column:
    return F.floor(day / 100).cast("int")


def _order_derived() -> dict[str, Column]:
    """Columns of an order fact's row that follow from its others."""
    return {"order_key": F.col("order_id"), "order_month": _month(F.col("order_date_id"))}


def _item_derived() -> dict[str, Column]:
    """Columns of a line fact's row that follow from its others."""
    return {"order_item_key": F.concat_ws("-", "order_id", "product_key"),
            "gross_margin": (F.col("subtotal") - F.col("cost_amount")).cast("decimal(12,2)")}


def fct_orders(
    orders: DataFrame, dim_customer: DataFrame, shipments: DataFrame,
    existing: DataFrame | None = None, update_cols: list[str] | None = None,
) -> DataFrame:
    """One row per order with the customer version valid when it was placed."""
    versions = dim_customer.select("customer_key", "user_id", "valid_from", "valid_to")
    rows = (
        as_of_join(orders, versions, "user_id", "order_date")
        .join(delivery_by_order(shipments), "order_id", "left")
        .select(
            F.col("order_id").alias("order_key"), "order_id", "customer_key",
            day_id(F.col("order_date")).alias("order_date_id"),
            "order_status", "total_amount", "discount_amount", "delivery_days",
            _month(day_id(F.col("order_date"))).alias("order_month"),
        )
    )
    if existing is None:
        return rows
    return upsert(existing, rows, ["order_id"], update_cols)


def fct_order_items(
    order_items: DataFrame, fct_orders: DataFrame, dim_product: DataFrame,
    existing: DataFrame | None = None, update_cols: list[str] | None = None, reject: bool = False,
    repeated_products: bool = True,
) -> DataFrame:
    """One row per order and product; repeated lines of a product are merged.

    Date and customer version come from the order fact, so lines are not matched against the
    customer history a second time. They are merged after that join: the grouping holds its key
    and needs no shuffle of its own. `reject` fails the job where two rows share order and product.
    Copies are counted before products are joined on, while lines are still dealt by order; those of
    products only if some may be `repeated_products`.
    """
    placed = fct_orders.select("order_id", "order_date_id", "customer_key", "order_month")
    merged = order_items.join(placed, "order_id").groupBy(
        "order_id", "product_id", "order_date_id", "customer_key", "order_month"
    ).agg(
        F.sum("quantity").alias("quantity"), F.max("unit_price").alias("unit_price"),
        F.sum("subtotal").cast("decimal(12,2)").alias("subtotal"),
    )
    costs = dim_product.select("product_key", "product_id", "unit_cost")
    if reject:
        merged = count_copies(merged, ["order_id", "product_id"], "_rows")
        costs = (count_copies(costs, ["product_id"], "_products") if repeated_products
                 else costs.withColumn("_products", F.lit(1)))
    cost = F.round(F.col("quantity") * F.col("unit_cost"), 2).cast("decimal(12,2)")
    priced = merged.join(costs, "product_id")
    if reject:
        priced = reject_counted(priced, ["order_id", "product_key"], ["_rows", "_products"])
    rows = priced.withColumn("cost_amount", cost).select(*[
        _item_derived()[c].alias(c) if c in _item_derived() else c for c in (
            "order_item_key", "order_id", "order_date_id", "customer_key", "product_key", "quantity",
            "unit_price", "cost_amount", "subtotal", "gross_margin", "order_month")])
    if existing is None:
        return rows
    return upsert(existing, rows, ["order_id", "product_key"], update_cols)


def pit_features(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Each order with the customer attributes valid at that moment, never later ones.

    Matched on user_id and the full timestamp. Matching midnight of the order date instead would
    lose orders placed on the day a version starts.
    """
    versions = dim_customer.select("user_id", "customer_key", F.col("city").alias(
        "historical_city"), "valid_from", "valid_to")
    return as_of_join(
        orders.select("order_id", "user_id", "order_date"), versions, "user_id", "order_date"
    ).select(
        "order_id", day_id(F.col("order_date")).alias("order_date_id"), "historical_city",
        "customer_key",
    )


def sync_order_totals(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """orders with total_amount set to the sum of the order's lines, where it has lines."""
    sums = order_items.groupBy("order_id").agg(F.sum("subtotal").alias("line_total"))
    return update_from(orders, sums, ["order_id"], {"total_amount": "line_total"})


# --- whole load ------------------------------------------------------------------------------

STAR_TABLES = list(STAR_DDL)
REJECTS = "dim_customer_rejects"


def load_star(
    shop: Shop, tables: VersionedTables, changes: DataFrame | None = None,
    update_cols: dict[str, list[str]] | None = None,
) -> None:
    """Bring all five star tables up to date. Running it again changes nothing.

    Each step reads what the step before it wrote, which also cuts the plan at every table. Facts
    are cut into files by date and then order, and sorted within, at any size: files hold disjoint
    ranges, a date filter skips files, and a busy day spans several. Changes that come too late for
    the history are stored as `dim_customer_rejects`, seen against the dimension before the step.
    Bounds of files come from the keys alone, so that the last join of a fact runs once. Of a fact
    that is there already only keys are shuffled, and rows that the sources no longer have.
    """
    with setting(shop.orders.sparkSession, CLEAN_UP, "true"):
        _load(shop, tables, changes, update_cols or {})


def _load(
    shop: Shop, tables: VersionedTables, changes: DataFrame | None, frozen: dict[str, list[str]],
) -> None:
    spark = shop.orders.sparkSession

    def old(name: str) -> DataFrame | None:
        return tables.read(name) if tables.exists(name) else None

    def write_fact(name: str, rows_of, by: list[str], new_keys, keys: DataFrame, rows: int,
                   derived: dict[str, Column]) -> DataFrame:
        """Merge rows_of into the fact: whole rows replace held ones, others are upserted.

        `new_keys` gives the keys of the rows, `keys` and `rows` tell the bounds of files.
        """
        held = old(name)
        if held is not None:
            keys, rows = keys.unionByName(some(held).select(*CUT)), max(rows, held.count())
        n = range_count(spark, rows)
        starts = range_starts(keys, *CUT, n)
        # A merge by order and product takes rows as they are, dealt by order.
        with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            if held is not None and frozen.get(name) is not None:
                df, derived = upsert(held, rows_of(False), by, frozen[name]), {}
            elif held is not None:
                apart = held_apart(held, new_keys, by)
                df = replace_rows(held, rows_of(True), by, apart)
                derived = derived if apart is None else {}  # held rows stay as they are
            else:
                df = rows_of(False)
            return tables.write(name, cut_by_range(df, starts, days, *CUT, n, derived))

    n_orders = shop.orders.count()

    def some(df: DataFrame) -> DataFrame:
        """The rows of some orders, the same ones of each table; all, if they are few."""
        parts = n_orders // CUT_ORDERS
        return df.where(F.pmod(F.xxhash64("order_id"), F.lit(parts)) == 0) if parts > 1 else df

    def write_customers() -> DataFrame:
        seen = tables.write("dim_customer", dim_customer(shop.users, old("dim_customer")))
        if changes is None:
            return seen
        tables.write(REJECTS, rejected_customer_changes(seen, changes))
        return tables.write("dim_customer", apply_customer_changes(seen, changes))

    # Dimensions are small and do not read each other, so they are made side by side.
    steps = [
        lambda: tables.write("dim_date", dim_date(order_years(shop.orders), old("dim_date")).coalesce(1)),
        lambda: tables.write("dim_product", dim_product(
            shop.products, shop.categories, old("dim_product"), frozen.get("dim_product"))),
        write_customers,
    ]
    with ThreadPoolExecutor(len(steps)) as pool:
        made = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        calendar, products, customers = (m.result() for m in made)
    days = [r[0] for r in calendar.select("date_id").distinct().collect()]
    placed = some(shop.orders).select(day_id(F.col("order_date")).alias(CUT[0]), "order_id")
    def order_rows(reject: bool) -> DataFrame:
        rows = fct_orders(shop.orders, customers, shop.shipments)
        return reject_duplicate_keys(rows, ["order_id"]) if reject else rows

    versions = customers.select("user_id", "valid_from", "valid_to")
    order_keys = as_of_join(
        shop.orders.select("order_id", "user_id", "order_date"), versions, "user_id", "order_date")
    orders = write_fact("fct_orders", order_rows, ["order_id"], order_keys, placed, n_orders,
                        _order_derived())
    lines = some(shop.order_items).select("order_id").join(some(orders).select(*CUT), "order_id")
    item_keys = shop.order_items.select("order_id", "product_id").join(
        products.select("product_id", "product_key"), "product_id").join(
        orders.select("order_id"), "order_id", "left_semi")

    def item_rows(reject: bool) -> DataFrame:
        repeated = reject and not products.groupBy("product_id").agg(
            F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        return fct_order_items(shop.order_items, orders, products, reject=reject, repeated_products=repeated)

    write_fact("fct_order_items", item_rows, ["order_id", "product_key"], item_keys, lines,
               shop.order_items.count(), _item_derived())


# --- checks ----------------------------------------------------------------------------------


def scd2_history_check(fct_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders per customer version number: old orders hold old versions, new ones the latest.

    `misplaced` counts orders whose date lies outside the version they point to; it must be 0.
    """
    dated = dim_customer.select(
        "customer_key", "is_current", day_id(F.col("valid_from")).alias("from_id"),
        day_id(F.col("valid_to")).alias("to_id"),
    )
    per_version = fct_orders.groupBy("customer_key", "order_date_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    day = F.col("order_date_id")
    outside = (day < F.col("from_id")) | F.coalesce(day > F.col("to_id"), F.lit(False))
    return (
        per_version.join(dated, "customer_key")
        .groupBy((F.col("customer_key") % VERSION_SPACE).alias("version_no"), "is_current")
        .agg(F.sum("n").alias("orders"), F.min("order_date_id").alias("first_date_id"),
             F.max("order_date_id").alias("last_date_id"),
             F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("misplaced"))
    )


def idempotence_check(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Per table the rows gained and lost between two states; zeros after a repeated load.

    Facts are compared by fingerprints of their months first.
    """
    parts = []
    for name, old in before.items():
        change = (row_diff_by(old, after[name], "order_month") if "order_month" in old.columns
                  else row_diff(old, after[name]))
        parts.append(change.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum(F.greatest("change", F.lit(0))), F.lit(0)).alias("rows_gained"),
            F.coalesce(F.sum(F.greatest(-F.col("change"), F.lit(0))), F.lit(0))
            .alias("rows_lost"),
        ))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
