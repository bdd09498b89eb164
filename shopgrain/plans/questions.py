"""Customer, sales and delivery questions on the shop tables.

Each function takes the tables it reads and returns its full result without a final order; order
and row limit of the printed report belong to `plans.catalogue`. Limits stay here only where the
question itself is a top-k.

Large tables are reduced before they meet: lines are summed per product, and orders per user,
before names are joined on. Joined dimensions carry no broadcast hint, so Spark broadcasts them
only while their size allows it. Counts of distinct orders are turned into counts of rows that an
earlier grouping already made unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.functions import (
    cents, day_name, dow_sunday0, mean, month_start, ntz, pct, ratio, round2, whole_days,
)
from shopgrain.operators import bitmaps
from shopgrain.operators.halo import with_halo
from shopgrain.operators.joins import label_null, not_exists, not_in
from shopgrain.operators.positions import exact_median, global_ntiles
from shopgrain.session import materialise

UNKNOWN_CITY = "Unknown"
DONE = "order_status = 'completed'"
BOUGHT = "order_status IN ('completed', 'returned')"
UNDONE = "order_status IN ('cancelled', 'returned')"


def _rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def _month_no() -> Column:
    return F.year("order_date") * 12 + F.month("order_date") - 1


def product_sales(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Units and revenue per product over completed orders."""
    done = orders.where(DONE).select("order_id")
    return (
        order_items.join(done, "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units"), F.sum("subtotal").alias("revenue"))
    )


# --- retention, value and rhythm of customers ------------------------------------------------


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Share of each first-purchase month's users who bought again n months later."""
    active = orders.where(BOUGHT).select("user_id", _month_no().alias("month_no")).distinct()
    first = F.min("month_no").over(W.partitionBy("user_id"))
    counts = (
        active.withColumn("cohort", first)
        .groupBy("cohort", (F.col("month_no") - F.col("cohort")).alias("month_offset"))
        .agg(_rows("active_users"))
    )
    return _retention_rates(counts)


def activity_delta(orders: DataFrame) -> DataFrame:
    """The months of buying of the users in a part of the orders, for a stored state."""
    return bitmaps.activity(orders.where(BOUGHT), "user_id", _month_no())


def cohort_retention_of_state(state: DataFrame) -> DataFrame:
    """`cohort_retention` from a stored state of months of buying."""
    return _retention_rates(bitmaps.retention_counts(state))


def _retention_rates(counts: DataFrame) -> DataFrame:
    # Every user is active in their own first month, so offset 0 holds the cohort size.
    started = F.when(F.col("month_offset") == 0, F.col("active_users"))
    sized = counts.withColumn("cohort_size", F.max(started).over(W.partitionBy("cohort")))
    cohort_month = F.make_date(
        F.floor(F.col("cohort") / 12).cast("int"), F.col("cohort") % 12 + 1, F.lit(1)
    )
    return sized.select(
        cohort_month.alias("cohort_month"), "cohort_size", "month_offset", "active_users",
        pct(F.col("active_users"), F.col("cohort_size")).alias("retention_pct"),
    )


def rfm_segments(orders: DataFrame, as_of: str) -> DataFrame:
    """Quintiles of recency, frequency and monetary value per user, and a segment name.

    Ties are broken by user_id. The per-user totals are written once, because finding the quintile
    borders reads them several times.
    """
    totals = materialise(
        orders.where(DONE)
        .groupBy("user_id")
        .agg(
            F.max("order_date").alias("last_order"),
            F.count("order_id").alias("frequency"),
            F.sum("total_amount").alias("monetary"),
        )
        .withColumn("recency", whole_days(F.col("last_order"), ntz(as_of)).cast("bigint"))
        .withColumn("_stale", -F.col("recency"))
        .withColumn("_cents", cents(F.col("monetary"))),
        "rfm",
    )

    recent, often, much = global_ntiles(
        totals, [[c, "user_id"] for c in ("_stale", "frequency", "_cents")], 5)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    # The thresholds and names of segments.
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("General")
    )
    return totals.select(
        "user_id", "recency", "frequency", "monetary",
        recent.alias("r_score"),
        often.alias("f_score"),
        much.alias("m_score"),
    ).withColumn("customer_segment", segment)


def purchase_streaks(orders: DataFrame, min_days: int = 2) -> DataFrame:
    """Runs of consecutive days on which a user bought."""
    days = orders.where(DONE).select(
        "user_id", F.to_date("order_date").alias("order_day")
    ).where(F.col("order_day").isNotNull()).distinct()
    position = F.row_number().over(W.partitionBy("user_id").orderBy("order_day"))
    return (
        days.withColumn("_island", F.date_sub("order_day", position))
        .groupBy("user_id", "_island")
        .agg(
            F.min("order_day").alias("streak_start"),
            F.max("order_day").alias("streak_end"),
            _rows("streak_length_days"),
        )
        .where(F.col("streak_length_days") >= min_days)
        .drop("_island")
    )


def second_order_gap(orders: DataFrame) -> DataFrame:
    """Days from first to second completed order over all users who have two.

    The position filter keeps two rows per user before the shuffle, whatever a user's order count.
    """
    by_time = W.partitionBy("user_id").orderBy("order_date")
    pairs = (
        orders.where(DONE)
        .select("user_id", "order_date", F.row_number().over(by_time).alias("seq"))
        .where(F.col("seq") <= 2)
        .groupBy("user_id")
        .agg(
            F.min("order_date").alias("first_at"),
            F.max("order_date").alias("second_at"),
            _rows("n"),
        )
        .where(F.col("n") == 2)
    )
    gap = whole_days(F.col("first_at"), F.col("second_at")).cast("bigint")
    # One row per distinct gap: the median merges a few thousand day counts, not all users.
    gaps = pairs.groupBy(gap.alias("days")).agg(_rows("users"))
    return gaps.agg(
        F.sum("users").alias("returning_users"),
        round2(ratio(F.sum(F.col("days") * F.col("users")), F.sum("users")))
        .alias("avg_days_to_second_order"),
        round2(F.percentile("days", 0.5, F.col("users"))).alias("median_days_to_second_order"),
    ).withColumn("returning_users", F.coalesce("returning_users", F.lit(0)))


def repeat_purchase_rate(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Share of sold products that some user bought in more than one order.

    Two different order ids exist exactly when the smallest differs from the largest.
    """
    done = orders.where(DONE).select("order_id", "user_id")
    pairs = (
        order_items.select("order_id", "product_id").join(done, "order_id")
        .groupBy("product_id", "user_id")
        .agg((F.min("order_id") < F.max("order_id")).alias("again"))
    )
    products = pairs.groupBy("product_id").agg(F.max("again").alias("again"))
    sold, again = F.count(F.lit(1)), F.count_if("again")
    return products.agg(
        sold.alias("total_distinct_products_sold"),
        again.alias("products_repurchased"),
        pct(again, sold).alias("repeat_purchase_rate_pct"),
    )


def days_to_first_order(users: DataFrame, orders: DataFrame) -> DataFrame:
    first = orders.groupBy("user_id").agg(F.min("order_date").alias("first_at"))
    days = whole_days(F.col("created_at"), F.col("first_at"))
    return (
        users.select("user_id", "created_at").join(first, "user_id")
        .agg(round2(mean(days)).alias("avg_days_to_first_order"))
    )


def _orders_by_user(users: DataFrame, orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("user_id").agg(F.count("order_id").alias("n"))
    return users.select("user_id").join(counts, "user_id", "left")


def inactive_users(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Users without orders, as a share of the rows of users LEFT JOIN orders.

    A user with n orders counts n times in the total; `inactive_users_distinct` counts users.
    """
    total = F.sum(F.coalesce("n", F.lit(1)))
    idle = F.count_if(F.col("n").isNull())
    return _orders_by_user(users, orders).agg(
        total.alias("total_users"), idle.alias("inactive_users"),
        pct(idle, total).alias("inactive_user_pct"),
    )


def inactive_users_distinct(users: DataFrame, orders: DataFrame) -> DataFrame:
    idle, total = F.count_if(F.col("n").isNull()), F.count(F.lit(1))
    return _orders_by_user(users, orders).agg(
        total.alias("total_users"), idle.alias("inactive_users"),
        pct(idle, total).alias("inactive_user_pct"),
    )


def active_users_left_form(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Users with orders, as a left join whose unmatched rows are dropped again.

    The optimizer sees that no unmatched row survives and plans the inner join.
    """
    joined = _orders_by_user(users, orders).where(F.col("n").isNotNull())
    return joined.select("user_id", F.col("n").alias("order_count"))


def orders_per_user(users: DataFrame, orders: DataFrame) -> DataFrame:
    return _orders_by_user(users, orders).agg(
        round2(ratio(F.sum(F.coalesce("n", F.lit(0))), F.count(F.lit(1))))
        .alias("orders_per_user")
    )


def orders_per_each_user(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Per user the true order count, next to what COUNT(*) after a left join would say."""
    return _orders_by_user(users, orders).select(
        "user_id",
        F.coalesce("n", F.lit(0)).alias("order_count"),
        F.coalesce("n", F.lit(1)).alias("joined_row_count"),
    )


# --- products and categories -----------------------------------------------------------------


def _daily_sales(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    done = orders.where(DONE).select("order_id", F.to_date("order_date").alias("sale_date"))
    return (
        order_items.join(done, "order_id")
        .groupBy("product_id", "sale_date")
        .agg(F.sum("quantity").alias("daily_quantity"), F.sum("subtotal").alias("daily_revenue"))
    )


def _moving_average(daily: DataFrame, products: DataFrame, window, *more: str) -> DataFrame:
    names = products.select("product_id", F.col("name").alias("product_name"))
    n = F.count(F.lit(1)).over(window)
    return daily.join(names, "product_id").select(
        "product_id", "product_name", "sale_date", "daily_quantity",
        round2(F.sum("daily_quantity").over(window).cast("double") / n)
        .alias("moving_avg_qty_7d"),
        round2(F.sum("daily_revenue").over(window).cast("double") / n)
        .alias("moving_avg_rev_7d"), *more,
    )


def moving_avg_7(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Average over a product's last seven selling days, however far apart they lie."""
    seven_rows = W.partitionBy("product_id").orderBy("sale_date").rowsBetween(-6, 0)
    return _moving_average(_daily_sales(order_items, orders), products, seven_rows)


def moving_avg_7_bucketed(
    order_items: DataFrame, orders: DataFrame, products: DataFrame, bucket_days: int = 366,
) -> DataFrame:
    """`moving_avg_7` with a product's days parted into buckets, so that one product spans tasks."""
    bucket = F.floor(F.unix_date("sale_date") / bucket_days)
    sales = materialise(_daily_sales(order_items, orders), "daily")  # read for rows and for halos
    daily = with_halo(sales, ["product_id"], "sale_date", bucket, 6)
    seven_rows = W.partitionBy("product_id", "_bucket").orderBy("sale_date").rowsBetween(-6, 0)
    return _moving_average(daily, products, seven_rows, "_halo").where("NOT _halo").drop("_halo")


def moving_avg_7_calendar(
    order_items: DataFrame, orders: DataFrame, products: DataFrame
) -> DataFrame:
    """Average over the selling days within the last seven calendar days."""
    daily = _daily_sales(order_items, orders)
    day_no = F.unix_date("sale_date")
    seven_days = W.partitionBy("product_id").orderBy(day_no).rangeBetween(-6, 0)
    return _moving_average(daily, products, seven_days)


def top3_per_category(
    categories: DataFrame, products: DataFrame, order_items: DataFrame, orders: DataFrame,
    k: int = 3,
) -> DataFrame:
    """Products whose revenue ranks in the first k of their category, ties included."""
    names = products.select("product_id", "category_id", F.col("name").alias("product_name"))
    labels = categories.select("category_id", F.col("name").alias("category_name"))
    by_revenue = W.partitionBy("category_id").orderBy(F.col("revenue").desc())
    return (
        product_sales(order_items, orders)
        .join(names, "product_id")
        .withColumn("rank_in_category", F.dense_rank().over(by_revenue))
        .where(F.col("rank_in_category") <= k)
        .join(labels, "category_id")
        .select(
            "category_name", "rank_in_category", "product_name",
            F.col("revenue").alias("total_revenue"), F.col("units").alias("total_units_sold"),
        )
    )


def return_rate_products(
    products: DataFrame, order_items: DataFrame, orders: DataFrame,
    min_orders: int = 50, k: int = 5, per_order: bool = False,
) -> DataFrame:
    """Products most often cancelled or returned, as a share of the orders that hold them.

    The plain form counts cancelled or returned lines, so an order with two such lines of one
    product counts twice; `per_order` counts orders on both sides.
    """
    # Lines of one product in one order collapse to a row, which is then one distinct order. The
    # grouping holds the join key, so it runs on the join's partitioning without a shuffle.
    status = orders.select("order_id", "order_status")
    lines = order_items.select("order_id", "product_id").join(status, "order_id").groupBy(
        "order_id", "product_id", "order_status"
    ).agg(_rows("lines"))
    bad_rows = F.lit(1) if per_order else F.col("lines")
    total = F.count(F.lit(1))
    bad = F.sum(F.when(F.expr(UNDONE), bad_rows).otherwise(0))
    rates = (
        lines
        .groupBy("product_id")
        .agg(total.alias("total_orders"), bad.alias("returned_or_cancelled"))
        .where(F.col("total_orders") >= min_orders)
        .withColumn("return_rate_pct",
                    pct(F.col("returned_or_cancelled"), F.col("total_orders")))
    )
    return (
        rates.join(products.select("product_id", "name"), "product_id")
        .select("product_id", "name", "total_orders", "returned_or_cancelled", "return_rate_pct")
        .orderBy(F.col("return_rate_pct").desc(), "product_id")
        .limit(k)
    )


def _ratings(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(
        round2(mean(F.col("rating"))).alias("avg_rating"),
        F.count("review_id").alias("review_count"),
    )


def top_rated_products(
    products: DataFrame, reviews: DataFrame, min_reviews: int = 20, k: int = 10
) -> DataFrame:
    return (
        _ratings(reviews).where(F.col("review_count") >= min_reviews)
        .join(products.select("product_id", "name"), "product_id")
        .select("product_id", "name", "avg_rating", "review_count")
        .orderBy(F.col("avg_rating").desc(), F.col("review_count").desc(), "product_id")
        .limit(k)
    )


def lowest_rated_products(products: DataFrame, reviews: DataFrame, k: int = 5) -> DataFrame:
    """Worst mean rating; a product without reviews rates 0."""
    return (
        products.select("product_id", "name").join(_ratings(reviews), "product_id", "left")
        .select(
            "product_id", "name",
            F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
            F.coalesce("review_count", F.lit(0)).alias("review_count"),
        )
        .orderBy("avg_rating", "review_count", "product_id")
        .limit(k)
    )


def top_outflow_products(products: DataFrame, movements: DataFrame, k: int = 10) -> DataFrame:
    out = (
        movements.where(F.col("movement_type") == "OUT")
        .groupBy("product_id").agg(F.sum("quantity").alias("total_outflow"))
    )
    return (
        out.join(products.select("product_id", "name"), "product_id")
        .select("product_id", "name", "total_outflow")
        .orderBy(F.col("total_outflow").desc(), "product_id")
        .limit(k)
    )


def inflow_by_reason(movements: DataFrame) -> DataFrame:
    return (
        movements.where(F.col("movement_type") == "IN")
        .groupBy("reference_reason")
        .agg(F.sum("quantity").alias("total_quantity"), _rows("movement_count"))
    )


def largest_lines(order_items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Lines with the most units, then the highest subtotal.

    Only lines whose product is known count, so a semi join on the product key comes before the
    limit; the names are then looked up for ten rows.
    """
    known = order_items.join(products.select("product_id"), "product_id", "left_semi")
    top = known.select("item_id", "order_id", "product_id", "quantity", "subtotal").orderBy(
        F.col("quantity").desc(), F.col("subtotal").desc(), "order_id", "item_id"
    ).limit(k)
    return top.join(products.select("product_id", "name"), "product_id").select(
        "order_id", "name", "quantity", "subtotal"
    )


def _margin(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "name", "price", "cost",
        pct(F.col("price") - F.col("cost"), F.col("price")).alias("margin_pct"),
    )


def lowest_margin_products(products: DataFrame, k: int = 5) -> DataFrame:
    return _margin(products).orderBy(F.col("margin_pct").asc_nulls_last(), "product_id").limit(k)


def highest_margin_products(products: DataFrame, k: int = 5) -> DataFrame:
    return _margin(products).orderBy(F.col("margin_pct").desc_nulls_last(), "product_id").limit(k)


def category_totals(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines sold and revenue per category, over orders of any status."""
    # item_id is a primary key, so counting it is counting rows.
    per_product = order_items.groupBy("product_id").agg(
        _rows("items"), F.sum("subtotal").alias("amount")
    )
    return (
        per_product.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("items").alias("items_sold"), F.sum("amount").alias("revenue"))
    )


def best_categories(totals: DataFrame, k: int) -> DataFrame:
    return totals.orderBy(F.col("revenue").desc(), "category_id").limit(k)


def category_sales(order_items: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """The k categories that earn most."""
    return best_categories(category_totals(order_items, products), k)


# --- revenue, orders and coupons -------------------------------------------------------------


def mom_growth(orders: DataFrame) -> DataFrame:
    """Revenue per month and its growth over the month before that has revenue."""
    monthly = (
        orders.where(DONE)
        .groupBy(month_start(F.col("order_date")).alias("sales_month"))
        .agg(F.sum("total_amount").alias("monthly_revenue"),
             F.count("order_id").alias("total_orders"))
    )
    # One row per calendar month is left, so this window is small whatever the order count.
    previous = F.lag("monthly_revenue", 1).over(W.orderBy("sales_month"))
    return monthly.withColumn("prev_month_revenue", previous).withColumn(
        "mom_growth_pct",
        pct(F.col("monthly_revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")),
    )


def running_revenue(orders: DataFrame) -> DataFrame:
    """Monthly revenue with its running total; the monthly rows stay."""
    monthly = (
        orders.where(DONE)
        .groupBy(month_start(F.col("order_date")).alias("sales_month"))
        .agg(F.sum("total_amount").alias("monthly_revenue"))
    )
    so_far = W.orderBy("sales_month").rowsBetween(W.unboundedPreceding, W.currentRow)
    return monthly.withColumn("running_revenue", F.sum("monthly_revenue").over(so_far))


def order_funnel(orders: DataFrame, payments: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders started, paid and delivered.

    Payments and shipments shrink to one row per order before they are joined, so nothing fans
    out and no distinct count is needed.
    """
    paid = payments.where(F.col("payment_status") == "successful").select("order_id").distinct()
    sent = shipments.where(F.col("shipment_status") == "delivered").select("order_id").distinct()
    joined = (
        orders.select("order_id")
        .join(paid.withColumn("paid", F.lit(1)), "order_id", "left")
        .join(sent.withColumn("sent", F.lit(1)), "order_id", "left")
    )
    started, payed, delivered = F.count(F.lit(1)), F.count("paid"), F.count("sent")
    return joined.agg(
        started.alias("total_initiated_orders"),
        payed.alias("paid_orders"),
        delivered.alias("delivered_orders"),
        pct(payed, started).alias("payment_conversion_pct"),
        pct(delivered, payed).alias("fulfillment_delivery_pct"),
    )


def coupon_margin(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, cost and margin of orders with and without a coupon.

    Lines move once, to the completed orders, and are summed per channel and product before costs
    are looked up. Orders are counted where they have a line of a known product.
    """
    channel = F.when(F.col("coupon_id").isNotNull(), "With coupon").otherwise("Without coupon")
    done = orders.where(DONE).select("order_id", channel.alias("sales_channel"))
    costs = products.select("product_id", "cost")
    lines = order_items.select("order_id", "product_id", "quantity", "subtotal")
    sold = lines.join(done, "order_id").groupBy("sales_channel", "product_id").agg(
        F.sum("quantity").alias("units"), F.sum("subtotal").alias("revenue"))
    sums = sold.join(costs, "product_id").groupBy("sales_channel").agg(
        F.sum("revenue").alias("gross_revenue"),
        F.sum(F.col("units") * F.col("cost")).alias("total_cost"))
    known = lines.join(costs.select("product_id"), "product_id", "left_semi")
    counts = done.join(known.select("order_id"), "order_id", "left_semi").groupBy(
        "sales_channel").agg(_rows("order_count"))
    totals = counts.join(sums, "sales_channel").select(
        "sales_channel", "order_count", "gross_revenue", "total_cost")
    profit = F.col("gross_revenue") - F.col("total_cost")
    return totals.withColumn("gross_profit", profit).withColumn(
        "profit_margin_pct", pct(profit, F.col("gross_revenue"))
    )


def city_revenue(
    users: DataFrame, orders: DataFrame, k: int = 10, label: str = UNKNOWN_CITY
) -> DataFrame:
    per_user = orders.where(DONE).groupBy("user_id").agg(
        F.count("order_id").alias("orders"), F.sum("total_amount").alias("amount")
    )
    return (
        users.select("user_id", "city").join(per_user, "user_id")
        .groupBy(label_null(F.col("city"), label).alias("city"))
        .agg(F.sum("orders").alias("total_orders"), F.sum("amount").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc_nulls_first(), "city")
        .limit(k)
    )


def order_value_profile(orders: DataFrame) -> DataFrame:
    """Mean, median and largest completed order; the median is exact and found by counting."""
    done = orders.where(DONE)
    middle = exact_median(done.select(cents(F.col("total_amount")).alias("c")), "c")
    median = F.lit(None if middle is None else middle / 100.0).cast("double")
    return done.agg(
        round2(mean(F.col("total_amount"))).alias("average_order_value"),
        round2(median).alias("median_order_value"),
        F.max("total_amount").alias("max_order_value"),
    )


def unused_coupons_not_in(coupons: DataFrame, orders: DataFrame) -> DataFrame:
    """Coupons NOT IN the coupons of orders: empty as soon as one order has no coupon."""
    return not_in(coupons, orders, "coupon_id").select("coupon_id", "code")


def unused_coupons_not_exists(coupons: DataFrame, orders: DataFrame) -> DataFrame:
    """Coupons for which no order exists."""
    return not_exists(coupons, orders, "coupon_id").select("coupon_id", "code")


def orders_by_weekday(orders: DataFrame) -> DataFrame:
    return (
        orders.where(DONE)
        .groupBy(dow_sunday0(F.col("order_date")).alias("day_of_week"))
        .agg(_rows("total_orders"), F.sum("total_amount").alias("total_revenue"))
        .select(day_name(F.col("day_of_week")).alias("day_name"), "day_of_week",
                "total_orders", "total_revenue")
    )


def orders_by_hour(orders: DataFrame) -> DataFrame:
    return orders.where(DONE).groupBy(F.hour("order_date").alias("order_hour")).agg(
        _rows("order_count")
    )


def top_coupons(coupons: DataFrame, orders: DataFrame, k: int = 5) -> DataFrame:
    used = orders.where(F.col("coupon_id").isNotNull()).groupBy("coupon_id").agg(
        F.count("order_id").alias("n"), F.sum("total_amount").alias("amount")
    )
    return (
        coupons.select("coupon_id", "code", "discount_pct").join(used, "coupon_id")
        .groupBy("code", "discount_pct")
        .agg(F.sum("n").alias("times_used"), F.sum("amount").alias("total_attributed_revenue"))
        .orderBy(F.col("times_used").desc(), "code")
        .limit(k)
    )


# --- payments and delivery -------------------------------------------------------------------


def payment_success(payments: DataFrame) -> DataFrame:
    ok, total = F.count_if(F.col("payment_status") == "successful"), F.count(F.lit(1))
    return payments.groupBy("payment_method").agg(
        total.alias("total_tx"), ok.alias("success_tx"), pct(ok, total).alias("success_rate_pct")
    )


def carrier_delivery_days(shipments: DataFrame) -> DataFrame:
    days = whole_days(F.col("shipped_at"), F.col("delivered_at"))
    return (
        shipments.where(F.col("shipment_status") == "delivered")
        .where(F.col("delivered_at") >= F.col("shipped_at"))
        .groupBy("carrier")
        .agg(round2(mean(days)).alias("avg_delivery_days"), _rows("total_shipments"))
    )


def delivery_anomalies(shipments: DataFrame) -> DataFrame:
    """Shipments that arrived before they left."""
    return shipments.where(F.col("delivered_at") < F.col("shipped_at")).select(
        "shipment_id", "order_id", "carrier", "shipped_at", "delivered_at"
    )


def split_shipments(shipments: DataFrame) -> DataFrame:
    return (
        shipments.groupBy("order_id").agg(F.count("shipment_id").alias("shipment_count"))
        .where(F.col("shipment_count") > 1)
    )
