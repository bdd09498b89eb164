"""Registry of all queries for the driver, and the SQL each is checked against."""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle.sql import all_sql
from shopgrain.functions import day_id, ntz
from shopgrain.operators import bitmaps
from shopgrain.operators.carry import as_of_carry
from shopgrain.plans import audits, history, layout, pairs, profiles, questions, star, trips
from shopgrain.plans.catalogue import catalogue
from shopgrain.session import materialise, scratch_dir, size_shuffles, tune
from shopgrain.sources import roles, tables
from shopgrain.sources.files import FileTable
from shopgrain.sources.report import write_report
from shopgrain.sources.schemas import STAR_DDL
from shopgrain.sources.tables import Shop
from shopgrain.sources.versions import VersionedTables

RFM_AS_OF = "2001-09-01 00:00:00"
MONTH = date(1998, 11, 1)
MOVED_AT = "1998-06-01 00:00:00"
MOVED_FROM = ["City 0", "City 1", "City 2", "City 3", "City 4"]
STAR_TABLES = star.STAR_TABLES

ShopReader = Callable[[SparkSession, str], Shop]

_loaded: set[str] = set()


def _root(spark: SparkSession, sf_dir: str) -> str:
    return f"{scratch_dir(spark)}/{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"


def moves(shop: Shop) -> DataFrame:
    """The change feed: users of five cities move away, users without a city get one."""
    moved = F.when(F.col("city").isNull(), "City 1").otherwise(
        F.concat("city", F.lit(" (moved)"))
    )
    return shop.users.where(F.col("city").isin(MOVED_FROM) | F.col("city").isNull()).select(
        "user_id", "email", "full_name", moved.alias("city"), ntz(MOVED_AT).alias("effective_at")
    )


def late_moves(shop: Shop) -> DataFrame:
    """Changes dated at, or a day before, the start of the user's first version."""
    start = F.col("created_at")
    at = F.when(F.col("city") == "City 0", start).otherwise(start - F.expr("INTERVAL 1 DAY"))
    return shop.users.where(F.col("city").isin("City 0", "City 1")).select(
        "user_id", "email", "full_name", F.concat("city", F.lit(" (late)")).alias("city"),
        at.alias("effective_at"),
    )


def mixed_moves(shop: Shop) -> DataFrame:
    """A feed with changes that apply, that are equal, that come late, and of unseen users."""
    feed = moves(shop).where("city <> 'City 0 (moved)'").unionByName(
        late_moves(shop).where("city = 'City 0 (late)'"))
    same = shop.users.where("city = 'City 5'").select(
        "user_id", "email", "full_name", "city", ntz(MOVED_AT).alias("effective_at"))
    # Mirrored below the lowest id: a negated id may be held, as 0 always is its own.
    lowest = shop.users.agg(F.min("user_id")).scalar()
    unseen = same.withColumn("user_id", 2 * lowest - 1 - F.col("user_id"))
    return feed.unionByName(same).unionByName(unseen)


def star_tables(
    spark: SparkSession, sf_dir: str, shop_of: ShopReader = roles.role_shop
) -> VersionedTables:
    """The star of a data set, loaded once per application into the shared scratch folder."""
    root = f"{_root(spark, sf_dir)}/star"
    stored = VersionedTables(spark, root, STAR_DDL)
    if root not in _loaded:
        shop = shop_of(spark, sf_dir)
        star.load_star(shop, stored, moves(shop))
        _loaded.add(root)
    return stored


def layout_table(
    spark: SparkSession, sf_dir: str, name: str, shop_of: ShopReader = roles.role_shop
) -> DataFrame:
    """A laid-out copy of a shop table, written once per application."""
    root = f"{_root(spark, sf_dir)}/layout"
    stored = VersionedTables(spark, root, layout.LAYOUT_DDL)
    if f"{root}/{name}" not in _loaded:
        layout.write_layout(shop_of(spark, sf_dir), stored, name)
        _loaded.add(f"{root}/{name}")
    return stored.read(name)


def portable(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, dates as text and integers as BIGINT, for comparison across engines."""
    def out(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double")
        if isinstance(field.dataType, T.DateType):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return c.cast("bigint")
        return c

    return df.select(*[out(f).alias(f.name) for f in df.schema.fields])


def _shop_queries() -> dict[str, Callable[[Shop], DataFrame]]:
    """Jobs that read the shop tables only."""
    found = {c.name: c.build for c in catalogue(RFM_AS_OF, min_orders=20)}
    a, q = audits, questions
    found |= {
        "moving_avg_7_calendar":
            lambda s: q.moving_avg_7_calendar(s.order_items, s.orders, s.products),
        "moving_avg_7_bucketed":
            lambda s: q.moving_avg_7_bucketed(s.order_items, s.orders, s.products),
        "running_revenue": lambda s: q.running_revenue(s.orders),
        "return_rate_products_distinct": lambda s: q.return_rate_products(
            s.products, s.order_items, s.orders, min_orders=20, per_order=True),
        "inactive_users_distinct": lambda s: q.inactive_users_distinct(s.users, s.orders),
        "active_users_left_form": lambda s: q.active_users_left_form(s.users, s.orders),
        "orders_per_each_user": lambda s: q.orders_per_each_user(s.users, s.orders),
        "unused_coupons_not_in": lambda s: q.unused_coupons_not_in(s.coupons, s.orders),
        "unused_coupons_not_in_known": lambda s: q.unused_coupons_not_in(
            s.coupons, s.orders.where("coupon_id IS NOT NULL")),
        "unused_coupons_not_exists": lambda s: q.unused_coupons_not_exists(s.coupons, s.orders),
        "monthly_revenue_oltp": lambda s: pairs.monthly_revenue_oltp(s.orders),
        "category_margin_oltp": lambda s: pairs.category_margin_oltp(
            s.order_items, s.products, s.categories, s.orders),
        "weekend_split_oltp": lambda s: pairs.weekend_split_oltp(s.orders),
        "city_revenue_hist_oltp": lambda s: pairs.city_revenue_hist_oltp(s.users, s.orders),
        "top5_units_oltp": lambda s: pairs.top5_units_oltp(s.order_items, s.products, s.orders),
        "avg_delivery_oltp": lambda s: pairs.avg_delivery_oltp(s.shipments),
        "quarterly_revenue_oltp": lambda s: pairs.quarterly_revenue_oltp(s.orders),
        "aov_oltp": lambda s: pairs.aov_oltp(s.orders),
        "top_spenders_oltp": lambda s: pairs.top_spenders_oltp(s.orders),
        "category_items_oltp": lambda s: pairs.category_items_oltp(
            s.order_items, s.products, s.categories),
        "payments_in_month_by_function":
            lambda s: layout.payments_in_month_by_function(s.payments, MONTH),
        "payments_successful": lambda s: layout.payments_successful(s.payments),
        "sync_order_totals": lambda s: star.sync_order_totals(s.orders, s.order_items).select(
            "order_id", "user_id", "order_status", "total_amount", "order_date"),
        "dim_customer_initial": lambda s: star.dim_customer(s.users),
        "dim_date_insert": _dim_date_insert,
        "dim_product_upsert": _dim_product_upsert,
        "rejected_customer_changes": lambda s: star.rejected_customer_changes(
            star.dim_customer(s.users), late_moves(s)),
        "star_change_outcomes": lambda s: star.change_outcomes(
            star.dim_customer(s.users), mixed_moves(s)),
        "audit_unique": a.audit_unique,
        "audit_not_null": a.audit_not_null,
        "audit_foreign_keys": a.audit_foreign_keys,
        "audit_domains": a.audit_domains,
        "audit_cross_column": a.audit_cross_column,
        "cascade_plan": lambda s: a.cascade_plan(
            s, s.users.where("phone IS NULL"), s.coupons.where("discount_pct = 25")),
        "table_counts": a.table_counts,
        "profile_nulls": lambda s: profiles.profile_nulls(s.users),
        "profile_pareto": lambda s: profiles.profile_pareto(s.order_items),
        "profile_seasonality": lambda s: profiles.profile_seasonality(s.orders),
        "profile_mix": lambda s: profiles.profile_mix(s.orders, s.payments, s.reviews),
    }
    return found


def _dim_date_insert(s: Shop) -> DataFrame:
    """Years before 1998 are held already, under upper-case month names, and stay as they are."""
    early = star.order_years(s.orders.where(F.year("order_date") < 1998))
    held = star.dim_date(early).withColumn("month_name", F.upper("month_name"))
    return star.dim_date(star.order_years(s.orders), held)


def _dim_product_upsert(s: Shop) -> DataFrame:
    """Some brands are held already with an old sku and price; the price moves, the sku stays."""
    held = star.dim_product(s.products, s.categories).where("category_name < 'Brand#2'")
    held = held.withColumn("sku", F.concat(F.lit("OLD-"), "sku")).withColumn(
        "unit_price", F.lit(1).cast("decimal(10,2)")
    )
    return star.dim_product(s.products, s.categories, held, [
        "product_name", "category_name", "unit_cost", "unit_price"])


def _star_queries() -> dict[str, Callable[..., DataFrame]]:
    """Jobs on the loaded star; each names the star tables it takes."""
    p = pairs

    def whole_star(audit):
        def run(dim_date, dim_product, dim_customer, fct_orders, fct_order_items):
            return audit(dict(zip(STAR_TABLES, (
                dim_date, dim_product, dim_customer, fct_orders, fct_order_items))))

        return run

    return {
        "dim_date": lambda dim_date: dim_date,
        "dim_product": lambda dim_product: dim_product,
        "dim_customer": lambda dim_customer: dim_customer,
        "fct_orders": lambda fct_orders: fct_orders.drop("order_month"),
        "fct_order_items":
            lambda fct_order_items: fct_order_items.drop("order_month"),
        "scd2_history_check": star.scd2_history_check,
        "scd2_audit": audits.scd2_audit,
        "star_audit_unique": whole_star(audits.star_audit_unique),
        "star_audit_not_null": whole_star(audits.star_audit_not_null),
        "star_audit_foreign_keys": whole_star(audits.star_audit_foreign_keys),
        "monthly_revenue_star": p.monthly_revenue_star,
        "monthly_revenue_named_star": p.monthly_revenue_named_star,
        "category_margin_star": p.category_margin_star,
        "weekend_split_star": p.weekend_split_star,
        "city_revenue_hist_star": p.city_revenue_hist_star,
        "top5_units_star": p.top5_units_star,
        "avg_delivery_star": p.avg_delivery_star,
        "quarterly_revenue_star": p.quarterly_revenue_star,
        "aov_star": p.aov_star,
        "top_spenders_star": p.top_spenders_star,
        "top_spenders_star_by_user": p.top_spenders_star_by_user,
        "category_items_star": p.category_items_star,
    }


def _trip_queries() -> dict[str, Callable[[DataFrame], DataFrame]]:
    names = ["trip_totals", "by_passengers", "by_passengers_strict", "revenue_by_payment",
             "tip_rate_zones", "tip_rate_zones_strict", "pickups_by_hour", "long_trips",
             "nonpositive_totals", "fastest_pairs", "fastest_pairs_strict", "airport_fees",
             "duration_bands", "duration_bands_strict"]
    return {name: getattr(trips, name) for name in names}


def _layout_queries() -> dict[str, tuple[str, Callable[[DataFrame], DataFrame]]]:
    return {
        "orders_month_status": (
            "orders_by_date", lambda df: layout.orders_month_status(df, MONTH)),
        "payments_in_month": (
            "payments_by_date", lambda df: layout.payments_in_month(df, MONTH)),
        "product_sales_point": (
            "items_by_product", lambda df: layout.product_sales_point(df, 42)),
        "returned_orders": ("orders_by_status", layout.returned_orders),
        "carrier_shipments": (
            "shipments_by_carrier", lambda df: layout.carrier_shipments(df, "Carrier D")),
        "user_by_email_ci": (
            "users_by_email",
            lambda df: layout.user_by_email_ci(df, "CUSTOMER#000000042@Example.com")),
    }


def _pit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = roles.role_shop(spark, sf_dir)
    return star.pit_features(shop.orders, star_tables(spark, sf_dir).read("dim_customer"))


def _idempotence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads a star of its own twice and compares the two states."""
    stored = VersionedTables(
        spark, f"{_root(spark, sf_dir)}/idempotence-{uuid.uuid4().hex}", STAR_DDL)
    shop = roles.role_shop(spark, sf_dir)
    star.load_star(shop, stored, moves(shop))
    before = {name: stored.read(name) for name in STAR_TABLES}
    star.load_star(shop, stored, moves(shop))
    return star.idempotence_check(before, {name: stored.read(name) for name in STAR_TABLES})


def _star_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects that a load stores for a mixed feed."""
    shop = roles.role_shop(spark, sf_dir)
    root = f"{_root(spark, sf_dir)}/mixed_star"
    stored = VersionedTables(spark, root, STAR_DDL)
    if root not in _loaded:
        star.load_star(shop, stored, mixed_moves(shop))
        _loaded.add(root)
    return stored.read(star.REJECTS)


def _asof_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pit_features by carrying versions forward."""
    orders = roles.role_shop(spark, sf_dir).orders.select("order_id", "user_id", "order_date")
    versions = star_tables(spark, sf_dir).read("dim_customer").select(
        "user_id", "customer_key", F.col("city").alias("historical_city"), "valid_from", "valid_to")
    found = as_of_carry(orders, versions, "user_id", "order_date")
    return found.select("order_id", day_id(F.col("order_date")).alias("order_date_id"),
                        "historical_city", "customer_key")


def late_feeds(shop: Shop) -> list[DataFrame]:
    """Three feeds of changes: some users have several in one feed, and many come late."""
    def change(condition: str, at: str, city: str) -> DataFrame:
        return shop.users.where(condition).select(
            "user_id", "email", "full_name", F.expr(city).alias("city"), ntz(at).alias(history.AT))

    moved = "concat(coalesce(city, 'nowhere'), ' (moved)')"
    return [
        change("user_id % 3 = 0", "1998-06-01 00:00:00", moved),
        change("user_id % 6 = 0", "1997-03-01 00:00:00", "'Stopover'").unionByName(
            change("user_id % 5 = 0", "1996-01-01 00:00:00", "'Early'")).unionByName(
            change("user_id % 5 = 0", "1999-01-01 00:00:00", "'Later'")),
        change("user_id % 3 = 0", "1999-06-01 00:00:00", moved).unionByName(
            change("user_id % 10 = 0", "1993-05-05 00:00:00", "'Before'")),
    ]


def history_tables(spark: SparkSession, sf_dir: str) -> VersionedTables:
    """The customer history after three feeds, the second and third with late changes."""
    root = f"{_root(spark, sf_dir)}/history"
    stored = VersionedTables(spark, root)
    if root not in _loaded:
        shop = roles.role_shop(spark, sf_dir)
        history.start_history(shop.users, shop.orders, stored)
        for feed in late_feeds(shop):
            history.take_feed(feed, stored)
        _loaded.add(root)
    return stored


def _join_fanout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = roles.role_shop(spark, sf_dir)
    customers = star_tables(spark, sf_dir).read("dim_customer")
    return audits.join_fanout_report({
        "orders to shipments: non-unique right key": (s.orders, s.shipments, ["order_id"]),
        "lines to lines: half of the key": (s.order_items, s.order_items, ["order_id"]),
        "lines to lines: whole key":
            (s.order_items, s.order_items, ["order_id", "product_id"]),
        "orders to customers: whole history": (s.orders, customers, ["user_id"]),
        "orders to customers: current version":
            (s.orders, customers.where("is_current"), ["user_id"]),
    })


def _incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of two months come in after the first load, and the statuses of one are corrected."""
    shop = roles.role_shop(spark, sf_dir)
    customers = star_tables(spark, sf_dir).read("dim_customer")
    facts = materialise(star.fct_orders(shop.orders, customers, shop.shipments), "facts")
    table = FileTable(spark, f"{_root(spark, sf_dir)}/incremental-{uuid.uuid4().hex}",
                      STAR_DDL["fct_orders"], ["order_id"], "order_date_id")
    month = F.col("order_month")
    table.write(facts.where(~month.isin(199807, 199808)).withColumn("order_status", F.when(
        month == 199806, "pending").otherwise(F.col("order_status"))))
    for number in (199808, 199806, 199807):
        table.merge(facts.where(month == number))
    return table.read().drop("order_month")


def _cohort_retention_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohorts from a stored state of activity that takes the orders in three parts."""
    orders = roles.role_shop(spark, sf_dir).orders
    stored = VersionedTables(spark, f"{_root(spark, sf_dir)}/activity-{uuid.uuid4().hex}")
    for part in range(3):
        state = questions.activity_delta(orders.where(F.col("order_id") % 3 == part))
        if stored.exists("activity"):
            state = bitmaps.merge(stored.read("activity"), state)
        stored.write("activity", state)
    return questions.cohort_retention_of_state(stored.read("activity"))


def _load_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that bring no registration time are stamped with the time of the load."""
    users = roles.role_shop(spark, sf_dir).users.drop("created_at", "phone")
    return tables.with_defaults(users, "users", MOVED_AT)


def _csv_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_root(spark, sf_dir)}/csv/users"
    tables.write_csv(roles.role_shop(spark, sf_dir).users, path, "users")
    return tables.read_csv(spark, path, "users")


def _parquet_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_root(spark, sf_dir)}/reload/coupons"
    coupons = roles.role_shop(spark, sf_dir).coupons.select("coupon_id", "code", "discount_pct")
    tables.reload_parquet(coupons.where("discount_pct < 25"), path)
    return tables.reload_parquet(coupons, path)


def _question_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed rows, their fields by name; numbers in hundredths, for comparison across engines."""
    report = write_report(catalogue(RFM_AS_OF, min_orders=20), roles.role_shop(spark, sf_dir),
                          f"{_root(spark, sf_dir)}/report-{uuid.uuid4().hex}")
    fields = F.map_entries(F.from_json("row", "map<string,string>"))

    def text(field):
        number = field["value"].try_cast("double")
        moment = F.regexp_replace(field["value"], r"^(\d{4}-\d\d-\d\d)T(\d\d:\d\d:\d\d)\.?0*Z?$", "$1 $2")
        shown = F.when(number.isNotNull(), F.round(number * 100).cast("bigint").cast("string"))
        return F.concat(field["key"], F.lit("="), F.coalesce(shown, moment, F.lit("NULL")))

    return report.select("question_id", "name", "position", F.array_join(
        F.array_sort(F.transform(fields, text)), "|").alias("fields"))


def _text_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries on texts; none where their subpackage or the pipeline has been removed."""
    try:
        from corpus_pipeline import queries as of_pipeline
        from shopgrain.llm.queries import queries as of_operators
    except ImportError:
        return {}
    return of_operators() | of_pipeline()


def _text_sql() -> dict[str, str]:
    try:
        from corpus_pipeline import oracle_sql as of_pipeline
        from shopgrain.llm.oracle import oracle_sql as of_operators
    except ImportError:
        return {}
    return of_operators() | of_pipeline()


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: month-over-month revenue growth."""
    return queries()["mom_growth"](spark, "/root/testdata/sf0.001")


def queries(
    shop_of: ShopReader = roles.role_shop,
    trips_of: Callable[[SparkSession, str], DataFrame] = roles.trips,
) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name; by default on the role views of the given tables."""
    def on_shop(build):
        return lambda spark, sf_dir: build(shop_of(spark, sf_dir))

    def on_star(build):
        wanted = [n for n in inspect.signature(build).parameters if n in STAR_TABLES]

        def run(spark, sf_dir):
            stored = star_tables(spark, sf_dir, shop_of)
            return build(*[stored.read(n) for n in wanted])

        return run

    def on_trips(build):
        return lambda spark, sf_dir: build(trips_of(spark, sf_dir))

    def on_layout(name, build):
        return lambda spark, sf_dir: build(layout_table(spark, sf_dir, name, shop_of))

    found = {name: on_shop(build) for name, build in _shop_queries().items()}
    found |= {name: on_star(build) for name, build in _star_queries().items()}
    found |= {name: on_trips(build) for name, build in _trip_queries().items()}
    found |= {name: on_layout(*spec) for name, spec in _layout_queries().items()}
    found |= {
        "pit_features": _pit_features,
        "asof_carry": _asof_carry,
        "scd2_late_changes":
            lambda spark, sf_dir: history_tables(spark, sf_dir).read("customer_versions"),
        "scd2_repointed_orders":
            lambda spark, sf_dir: history_tables(spark, sf_dir).read("dated_orders"),
        "idempotence_check": _idempotence_check,
        "join_fanout_report": _join_fanout_report,
        "star_rejects": _star_rejects,
        "csv_bulk_load": _csv_bulk_load,
        "incremental_load": _incremental_load,
        "load_defaults": _load_defaults,
        "cohort_retention_state": _cohort_retention_state,
        "parquet_reload": _parquet_reload,
        "question_report": _question_report,
    }

    def checked(build):
        return lambda spark, sf_dir: portable(build(size_shuffles(tune(spark), sf_dir), sf_dir))

    def tuned(build):
        return lambda spark, sf_dir: build(tune(spark), sf_dir)

    checked_queries = {name: checked(build) for name, build in found.items()}
    return checked_queries | {name: tuned(build) for name, build in _text_queries().items()}


def oracle_sql() -> dict[str, str]:
    return all_sql() | _text_sql()
