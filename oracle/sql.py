"""The registered queries as SQL for the checking engine, written apart from the Spark jobs.

Result types are brought to BIGINT, DOUBLE, VARCHAR, BOOLEAN and TIMESTAMP on both sides, because
the two engines hand decimals and dates to their clients in different ways.
"""

from oracle.roles import with_roles

_TYPES = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN", "t": "TIMESTAMP"}
LABEL = "COALESCE(city, 'Unknown')"
SINCE = "TIMESTAMP '1998-06-01 00:00:00'"
MOVERS = "(city IN ('City 0', 'City 1', 'City 2', 'City 3', 'City 4') OR city IS NULL)"


def q(roles: str, columns: str, sql: str) -> str:
    """`columns` lists name:type pairs of the result of `sql`."""
    pairs = [c.split(":") for c in columns.split()]
    casts = ", ".join(f"CAST({n} AS {_TYPES[t]}) AS {n}" for n, t in pairs)
    return with_roles(roles, f"SELECT {casts} FROM ({sql}) AS result")


def rnd(x: str, places: int = 2) -> str:
    scale = f"{10 ** places}.0"
    d = f"CAST({x} AS DOUBLE)"
    return f"(sign({d}) * floor(abs({d}) * {scale} + 0.5) / {scale} + 0.0)"


def pct(a: str, b: str) -> str:
    return rnd(f"CAST({a} AS DOUBLE) * 100.0 / NULLIF(CAST({b} AS DOUBLE), 0)")


def avg(x: str, places: int = 2) -> str:
    return rnd(f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)", places)


def days(a: str, b: str) -> str:
    """Completed 24-hour periods, cut towards zero."""
    return f"CAST(trunc(epoch({b} - {a}) / 86400) AS BIGINT)"


DATE_ID = "CAST(strftime(order_date, '%Y%m%d') AS BIGINT)"


def _questions() -> dict[str, str]:
    s: dict[str, str] = {}
    s["cohort_retention"] = q(
        "orders",
        "cohort_month:s cohort_size:i month_offset:i active_users:i retention_pct:d",
        f"""WITH bought AS (SELECT user_id, order_date, MIN(order_date) OVER (PARTITION BY user_id)
                AS first_date FROM r_orders WHERE order_status IN ('completed', 'returned')),
            active AS (SELECT CAST(date_trunc('month', first_date) AS DATE) AS cohort_month,
                date_diff('month', first_date, order_date) AS month_offset,
                COUNT(DISTINCT user_id) AS active_users FROM bought GROUP BY ALL)
            SELECT a.*, z.active_users AS cohort_size,
              {pct('a.active_users', 'z.active_users')} AS retention_pct
            FROM active a JOIN active z USING (cohort_month) WHERE z.month_offset = 0""")
    s["cohort_retention_state"] = s["cohort_retention"]
    s["rfm_segments"] = q(
        "orders",
        "user_id:i recency:i frequency:i monetary:d r_score:i f_score:i m_score:i "
        "customer_segment:s",
        f"""WITH raw AS (SELECT user_id, {days("MAX(order_date)", "TIMESTAMP '2001-09-01'")}
                AS recency, COUNT(*) AS frequency, SUM(total_amount) AS monetary
              FROM r_orders WHERE order_status = 'completed' GROUP BY user_id),
            t AS (SELECT *, NTILE(5) OVER (ORDER BY recency DESC, user_id) AS r_score,
                NTILE(5) OVER (ORDER BY frequency, user_id) AS f_score,
                NTILE(5) OVER (ORDER BY monetary, user_id) AS m_score FROM raw)
            SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
              WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
              WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
              WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost' ELSE 'General' END
              AS customer_segment FROM t""")
    daily = """WITH d AS (SELECT oi.product_id, p.name AS product_name,
                CAST(order_date AS DATE) AS sale_date, SUM(quantity) AS dq, SUM(subtotal) AS dr
              FROM r_order_items oi JOIN r_orders o ON oi.order_id = o.order_id
              JOIN r_products p ON oi.product_id = p.product_id
              WHERE order_status = 'completed' GROUP BY 1, 2, 3)"""
    for key, frame in (
        ("moving_avg_7", "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"),
        ("moving_avg_7_calendar",
         "RANGE BETWEEN INTERVAL '6' DAY PRECEDING AND CURRENT ROW"),
    ):
        over = f"OVER (PARTITION BY product_id ORDER BY sale_date {frame})"
        qty = rnd(f"CAST(SUM(dq) {over} AS DOUBLE) / COUNT(*) {over}")
        rev = rnd(f"CAST(SUM(dr) {over} AS DOUBLE) / COUNT(*) {over}")
        s[key] = q(
            "order_items orders products",
            "product_id:i product_name:s sale_date:s daily_quantity:i moving_avg_qty_7d:d "
            "moving_avg_rev_7d:d",
            f"""{daily} SELECT product_id, product_name, sale_date, dq AS daily_quantity,
                {qty} AS moving_avg_qty_7d, {rev} AS moving_avg_rev_7d FROM d""")
    s["moving_avg_7_bucketed"] = s["moving_avg_7"]
    s["purchase_streaks"] = q(
        "orders", "user_id:i streak_start:s streak_end:s streak_length_days:i",
        """WITH days AS (SELECT user_id, CAST(order_date AS DATE) AS day FROM r_orders
              WHERE order_status = 'completed' GROUP BY ALL),
            starts AS (SELECT *, day IS DISTINCT FROM LAG(day) OVER u + 1 AS begins FROM days
              WINDOW u AS (PARTITION BY user_id ORDER BY day)),
            runs AS (SELECT *, COUNT(*) FILTER (WHERE begins) OVER (PARTITION BY user_id
              ORDER BY day) AS run FROM starts)
            SELECT user_id, MIN(day) AS streak_start, MAX(day) AS streak_end,
              MAX(day) - MIN(day) + 1 AS streak_length_days
            FROM runs GROUP BY user_id, run HAVING MAX(day) > MIN(day)""")
    s["top3_per_category"] = q(
        "categories products order_items orders",
        "category_name:s rank_in_category:i product_name:s total_revenue:d total_units_sold:i",
        """WITH sold AS (SELECT product_id, SUM(subtotal) AS total_revenue,
              SUM(quantity) AS total_units_sold FROM r_order_items WHERE order_id IN
              (SELECT order_id FROM r_orders WHERE order_status = 'completed') GROUP BY 1)
            SELECT c.name AS category_name, p.name AS product_name, total_revenue,
              total_units_sold, 1 + (SELECT COUNT(DISTINCT o.total_revenue) FROM sold o
                JOIN r_products op USING (product_id) WHERE op.category_id = p.category_id
                AND o.total_revenue > sold.total_revenue) AS rank_in_category
            FROM sold JOIN r_products p USING (product_id)
            JOIN r_categories c USING (category_id) WHERE rank_in_category <= 3""")
    monthly = """WITH m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
                SUM(total_amount) AS monthly_revenue, COUNT(order_id) AS total_orders
              FROM r_orders WHERE order_status = 'completed' GROUP BY 1)"""
    growth = pct("(monthly_revenue - prev_month_revenue)", "prev_month_revenue")
    s["mom_growth"] = q(
        "orders",
        "sales_month:s monthly_revenue:d total_orders:i prev_month_revenue:d mom_growth_pct:d",
        f"""{monthly}, l AS (SELECT *, LAG(monthly_revenue) OVER (ORDER BY sales_month)
              AS prev_month_revenue FROM m) SELECT *, {growth} AS mom_growth_pct FROM l""")
    s["running_revenue"] = q(
        "orders", "sales_month:s monthly_revenue:d running_revenue:d",
        f"""{monthly} SELECT sales_month, monthly_revenue, SUM(monthly_revenue)
            OVER (ORDER BY sales_month) AS running_revenue FROM m""")
    s["order_funnel"] = q(
        "orders payments shipments",
        "total_initiated_orders:i paid_orders:i delivered_orders:i payment_conversion_pct:d "
        "fulfillment_delivery_pct:d",
        f"""WITH n AS (SELECT COUNT(*) AS total_initiated_orders,
              COUNT(*) FILTER (WHERE order_id IN (SELECT order_id FROM r_payments
                WHERE payment_status = 'successful')) AS paid_orders,
              COUNT(*) FILTER (WHERE order_id IN (SELECT order_id FROM r_shipments
                WHERE shipment_status = 'delivered')) AS delivered_orders FROM r_orders)
            SELECT *, {pct('paid_orders', 'total_initiated_orders')} AS payment_conversion_pct,
              {pct('delivered_orders', 'paid_orders')} AS fulfillment_delivery_pct FROM n""")
    s["coupon_margin"] = q(
        "orders order_items products",
        "sales_channel:s order_count:i gross_revenue:d total_cost:d gross_profit:d "
        "profit_margin_pct:d",
        f"""WITH lines AS (SELECT order_id, subtotal, quantity * (SELECT cost FROM r_products p
                WHERE p.product_id = i.product_id) AS cost FROM r_order_items i),
            sums AS (SELECT coupon_id IS NULL AS plain, COUNT(DISTINCT order_id) AS order_count,
                SUM(subtotal) AS gross_revenue, SUM(cost) AS total_cost
              FROM r_orders JOIN lines USING (order_id) WHERE order_status = 'completed'
              GROUP BY 1)
            SELECT *, if(plain, 'Without coupon', 'With coupon') AS sales_channel,
              gross_revenue - total_cost AS gross_profit,
              {pct('(gross_revenue - total_cost)', 'gross_revenue')} AS profit_margin_pct
            FROM sums""")
    s["second_order_gap"] = q(
        "orders",
        "returning_users:i avg_days_to_second_order:d median_days_to_second_order:d",
        f"""WITH dates AS (SELECT list(order_date ORDER BY order_date) AS d FROM r_orders
              WHERE order_status = 'completed' GROUP BY user_id HAVING COUNT(*) >= 2),
            g AS (SELECT {days('d[1]', 'd[2]')} AS gap FROM dates)
            SELECT COUNT(*) AS returning_users, {avg('gap')} AS avg_days_to_second_order,
              {rnd('median(CAST(gap AS DOUBLE))')} AS median_days_to_second_order FROM g""")
    s["repeat_purchase_rate"] = q(
        "orders order_items",
        "total_distinct_products_sold:i products_repurchased:i repeat_purchase_rate_pct:d",
        f"""WITH bought AS (SELECT product_id, user_id, order_id FROM r_order_items
              JOIN r_orders USING (order_id) WHERE order_status = 'completed' GROUP BY ALL),
            n AS (SELECT COUNT(DISTINCT product_id) AS sold, COUNT(DISTINCT product_id) FILTER (
                WHERE (product_id, user_id) IN (SELECT (product_id, user_id) FROM bought
                GROUP BY ALL HAVING COUNT(*) > 1)) AS again FROM bought)
            SELECT sold AS total_distinct_products_sold, again AS products_repurchased,
              {pct('again', 'sold')} AS repeat_purchase_rate_pct FROM n""")
    s["payment_success"] = q(
        "payments", "payment_method:s total_tx:i success_tx:i success_rate_pct:d",
        f"""WITH n AS (SELECT payment_method, COUNT(*) AS total_tx,
              COUNT(*) FILTER (WHERE payment_status = 'successful') AS success_tx
              FROM r_payments GROUP BY 1)
            SELECT *, {pct('success_tx', 'total_tx')} AS success_rate_pct FROM n""")
    s["carrier_delivery_days"] = q(
        "shipments", "carrier:s avg_delivery_days:d total_shipments:i",
        f"""SELECT carrier, {avg(days('shipped_at', 'delivered_at'))} AS avg_delivery_days,
              COUNT(*) AS total_shipments FROM r_shipments
            WHERE shipment_status = 'delivered' AND delivered_at >= shipped_at GROUP BY 1""")
    s["delivery_anomalies"] = q(
        "shipments", "shipment_id:i order_id:i carrier:s shipped_at:t delivered_at:t",
        """SELECT shipment_id, order_id, carrier, shipped_at, delivered_at FROM r_shipments
           WHERE delivered_at < shipped_at""")
    s["city_revenue"] = q(
        "users orders", "city:s total_orders:i total_revenue:d",
        f"""SELECT {LABEL} AS city, COUNT(DISTINCT order_id) AS total_orders,
              SUM(total_amount) AS total_revenue
            FROM r_users u JOIN r_orders o ON u.user_id = o.user_id
            WHERE order_status = 'completed' GROUP BY 1
            ORDER BY total_revenue DESC, city LIMIT 10""")
    for key, bad in (
        ("return_rate_products",
         "SUM(CASE WHEN order_status IN ('cancelled', 'returned') THEN 1 ELSE 0 END)"),
        ("return_rate_products_distinct",
         "COUNT(DISTINCT CASE WHEN order_status IN ('cancelled', 'returned') "
         "THEN o.order_id END)"),
    ):
        rate = pct(bad, "COUNT(DISTINCT o.order_id)")
        s[key] = q(
            "products order_items orders",
            "product_id:i name:s total_orders:i returned_or_cancelled:i return_rate_pct:d",
            f"""SELECT p.product_id, p.name, COUNT(DISTINCT o.order_id) AS total_orders,
                  {bad} AS returned_or_cancelled, {rate} AS return_rate_pct
                FROM r_products p JOIN r_order_items oi ON p.product_id = oi.product_id
                JOIN r_orders o ON oi.order_id = o.order_id GROUP BY 1, 2
                HAVING COUNT(DISTINCT o.order_id) >= 20
                ORDER BY return_rate_pct DESC, p.product_id LIMIT 5""")
    s["order_value_profile"] = q(
        "orders", "average_order_value:d median_order_value:d max_order_value:d",
        f"""SELECT {avg('total_amount')} AS average_order_value,
              {rnd('quantile_cont(CAST(total_amount AS DOUBLE), 0.5)')} AS median_order_value,
              MAX(total_amount) AS max_order_value
            FROM r_orders WHERE order_status = 'completed'""")
    rated = "product_id:i name:s avg_rating:d review_count:i"
    s["top_rated_products"] = q(
        "products reviews", rated,
        f"""SELECT p.product_id, p.name, {avg('rating')} AS avg_rating,
              COUNT(review_id) AS review_count
            FROM r_products p JOIN r_reviews r ON p.product_id = r.product_id GROUP BY 1, 2
            HAVING COUNT(review_id) >= 20
            ORDER BY avg_rating DESC, review_count DESC, p.product_id LIMIT 10""")
    s["lowest_rated_products"] = q(
        "products reviews", rated,
        f"""SELECT p.product_id, p.name, COALESCE({avg('rating')}, 0) AS avg_rating,
              COUNT(review_id) AS review_count
            FROM r_products p LEFT JOIN r_reviews r ON p.product_id = r.product_id GROUP BY 1, 2
            ORDER BY avg_rating, review_count, p.product_id LIMIT 5""")
    s["orders_by_weekday"] = q(
        "orders", "day_name:s day_of_week:i total_orders:i total_revenue:d",
        """SELECT dayname(order_date) AS day_name, dayofweek(order_date) AS day_of_week,
             COUNT(*) AS total_orders, SUM(total_amount) AS total_revenue
           FROM r_orders WHERE order_status = 'completed' GROUP BY 1, 2""")
    s["orders_by_hour"] = q(
        "orders", "order_hour:i order_count:i",
        """SELECT hour(order_date) AS order_hour, COUNT(*) AS order_count FROM r_orders
           WHERE order_status = 'completed' GROUP BY 1""")
    s["top_outflow_products"] = q(
        "products inventory_movements", "product_id:i name:s total_outflow:i",
        """SELECT p.product_id, p.name, SUM(quantity) AS total_outflow FROM r_products p
           JOIN r_inventory_movements m ON p.product_id = m.product_id
           WHERE movement_type = 'OUT' GROUP BY 1, 2
           ORDER BY total_outflow DESC, p.product_id LIMIT 10""")
    s["inflow_by_reason"] = q(
        "inventory_movements", "reference_reason:s total_quantity:i movement_count:i",
        """SELECT reference_reason, SUM(quantity) AS total_quantity,
             COUNT(*) AS movement_count FROM r_inventory_movements
           WHERE movement_type = 'IN' GROUP BY 1""")
    s["largest_lines"] = q(
        "order_items products", "order_id:i name:s quantity:i subtotal:d",
        """SELECT order_id, name, quantity, subtotal FROM r_order_items oi
           JOIN r_products p ON oi.product_id = p.product_id
           ORDER BY quantity DESC, subtotal DESC, order_id, item_id LIMIT 10""")
    s["days_to_first_order"] = q(
        "users orders", "avg_days_to_first_order:d",
        f"""WITH f AS (SELECT user_id, MIN(order_date) AS first_at FROM r_orders GROUP BY 1)
            SELECT {avg(days('created_at', 'first_at'))} AS avg_days_to_first_order
            FROM r_users u JOIN f ON u.user_id = f.user_id""")
    idle = "COUNT(CASE WHEN order_id IS NULL THEN 1 END)"
    for key, total in (("inactive_users", "COUNT(u.user_id)"),
                       ("inactive_users_distinct", "COUNT(DISTINCT u.user_id)")):
        s[key] = q(
            "users orders", "total_users:i inactive_users:i inactive_user_pct:d",
            f"""SELECT {total} AS total_users, {idle} AS inactive_users,
                  {pct(idle, total)} AS inactive_user_pct
                FROM r_users u LEFT JOIN r_orders o ON u.user_id = o.user_id""")
    s["active_users_left_form"] = q(
        "users orders", "user_id:i order_count:i",
        """SELECT u.user_id, COUNT(*) AS order_count FROM r_users u
           JOIN r_orders o ON u.user_id = o.user_id GROUP BY 1""")
    s["top_coupons"] = q(
        "coupons orders", "code:s discount_pct:d times_used:i total_attributed_revenue:d",
        """SELECT code, discount_pct, COUNT(order_id) AS times_used,
             SUM(total_amount) AS total_attributed_revenue
           FROM r_coupons c JOIN r_orders o ON c.coupon_id = o.coupon_id GROUP BY 1, 2
           ORDER BY times_used DESC, code LIMIT 5""")
    s["split_shipments"] = q(
        "shipments", "order_id:i shipment_count:i",
        """SELECT order_id, COUNT(shipment_id) AS shipment_count FROM r_shipments
           GROUP BY 1 HAVING COUNT(shipment_id) > 1""")
    s["orders_per_user"] = q(
        "users orders", "orders_per_user:d",
        f"""SELECT {rnd('CAST(COUNT(order_id) AS DOUBLE) / COUNT(DISTINCT u.user_id)')}
            AS orders_per_user FROM r_users u LEFT JOIN r_orders o ON u.user_id = o.user_id""")
    for key, way in (("lowest_margin_products", "ASC"), ("highest_margin_products", "DESC")):
        s[key] = q(
            "products", "product_id:i name:s price:d cost:d margin_pct:d",
            f"""SELECT product_id, name, price, cost, {pct('(price - cost)', 'price')}
                AS margin_pct FROM r_products
                ORDER BY margin_pct {way} NULLS LAST, product_id LIMIT 5""")
    for k in range(3, 8):
        s[f"category_sales_top{k}"] = q(
            "order_items products", "category_id:i items_sold:i revenue:d",
            f"""SELECT category_id, COUNT(item_id) AS items_sold, SUM(subtotal) AS revenue
                FROM r_order_items oi JOIN r_products p ON oi.product_id = p.product_id
                GROUP BY 1 ORDER BY revenue DESC, category_id LIMIT {k}""")
    s["unused_coupons_not_in"] = q(
        "coupons orders", "coupon_id:i code:s",
        """SELECT coupon_id, code FROM r_coupons
           WHERE coupon_id NOT IN (SELECT coupon_id FROM r_orders)""")
    s["unused_coupons_not_in_known"] = q(
        "coupons orders", "coupon_id:i code:s",
        """SELECT coupon_id, code FROM r_coupons WHERE coupon_id NOT IN (
           SELECT coupon_id FROM r_orders WHERE coupon_id IS NOT NULL)""")
    s["unused_coupons_not_exists"] = q(
        "coupons orders", "coupon_id:i code:s",
        """SELECT coupon_id, code FROM r_coupons c WHERE NOT EXISTS
           (SELECT 1 FROM r_orders o WHERE o.coupon_id = c.coupon_id)""")
    return s


def _trips() -> dict[str, str]:
    s: dict[str, str] = {}
    total, dist = "CAST(total_amount AS DECIMAL(28,6))", "CAST(trip_distance AS DECIMAL(28,6))"
    minutes = "date_diff('minute', pickup_at, dropoff_at)"
    exact = "(epoch_us(dropoff_at) - epoch_us(pickup_at)) / 60000000.0"
    s["trip_totals"] = q("trips", "trips:i avg_total:d",
                         f"SELECT COUNT(*) AS trips, {avg(total, 4)} AS avg_total FROM r_trips")
    s["by_passengers"] = q(
        "trips", "passenger_count:i trips:i avg_distance:d",
        f"""SELECT passenger_count, COUNT(*) AS trips, {avg(dist, 4)} AS avg_distance
            FROM r_trips GROUP BY 1""")
    s["by_passengers_strict"] = q(
        "trips", "passenger_count:i trips:i avg_distance:d",
        f"""SELECT passenger_count, COUNT(trip_distance) AS trips, {avg(dist, 4)}
            AS avg_distance FROM r_trips WHERE passenger_count IS NOT NULL GROUP BY 1""")
    s["revenue_by_payment"] = q(
        "trips", "payment_type:i revenue:d",
        f"SELECT payment_type, SUM({total}) AS revenue FROM r_trips GROUP BY 1")
    rate = rnd("AVG(tip_amount / NULLIF(total_amount, 0))", 6)
    for key, where in (("tip_rate_zones", ""),
                       ("tip_rate_zones_strict", "WHERE total_amount > 0")):
        s[key] = q(
            "trips", "pu_location_id:i tip_rate:d",
            f"""SELECT pu_location_id, {rate} AS tip_rate FROM r_trips {where} GROUP BY 1
                HAVING COUNT(*) > 1000 ORDER BY tip_rate DESC NULLS LAST, pu_location_id
                LIMIT 5""")
    s["pickups_by_hour"] = q(
        "trips", "pickup_hour:i trips:i",
        "SELECT hour(pickup_at) AS pickup_hour, COUNT(*) AS trips FROM r_trips GROUP BY 1")
    s["long_trips"] = q(
        "trips", "trips:i avg_total:d",
        f"""SELECT COUNT(*) AS trips, {avg(total, 4)} AS avg_total FROM r_trips
            WHERE trip_distance > 20""")
    s["nonpositive_totals"] = q(
        "trips", "trips:i", "SELECT COUNT(*) AS trips FROM r_trips WHERE total_amount <= 0")
    for key, m in (("fastest_pairs", minutes), ("fastest_pairs_strict", exact)):
        s[key] = q(
            "trips", "pu_location_id:i do_location_id:i avg_mph:d",
            f"""SELECT pu_location_id, do_location_id,
                  {rnd(f'AVG(trip_distance / NULLIF({m}, 0)) * 60', 4)} AS avg_mph
                FROM r_trips WHERE {m} BETWEEN 5 AND 120 GROUP BY 1, 2 HAVING COUNT(*) > 100
                ORDER BY avg_mph DESC, pu_location_id, do_location_id LIMIT 5""")
    s["airport_fees"] = q(
        "trips", "trips:i fees:d",
        "SELECT COUNT(*) AS trips, SUM(airport_fee) AS fees FROM r_trips WHERE airport_fee > 0")
    bands = "trip_type:s trips:i avg_total:d"
    s["duration_bands"] = q(
        "trips", bands,
        f"""SELECT CASE WHEN {minutes} < 10 THEN 'short (<10 min)'
              WHEN {minutes} BETWEEN 10 AND 30 THEN 'medium (10-30 min)'
              ELSE 'long (>30 min)' END AS trip_type, COUNT(*) AS trips,
              {avg(total, 4)} AS avg_total FROM r_trips GROUP BY 1""")
    s["duration_bands_strict"] = q(
        "trips", bands,
        f"""SELECT CASE WHEN {exact} <= 10 THEN 'short (<10 min)'
              WHEN {exact} <= 30 THEN 'medium (10-30 min)' ELSE 'long (>30 min)' END
              AS trip_type, COUNT(total_amount) AS trips, {avg(total, 4)} AS avg_total
            FROM r_trips WHERE dropoff_at IS NOT NULL AND pickup_at IS NOT NULL GROUP BY 1""")
    return s


# The star tables, written out as common table expressions over the roles.
_DIM_DATE = """dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id,
  CAST(d AS DATE) AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
  monthname(d) AS month_name, day(d) AS day, dayname(d) AS day_name,
  isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(
    (SELECT date_trunc('year', MIN(order_date)) FROM r_orders),
    (SELECT date_trunc('year', MAX(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY
     FROM r_orders), INTERVAL 1 DAY)) AS d))"""
_DIM_PRODUCT = """dim_product AS (SELECT product_id AS product_key, product_id, sku,
  p.name AS product_name, c.name AS category_name, cost AS unit_cost, price AS unit_price
  FROM r_products p JOIN r_categories c ON p.category_id = c.category_id)"""
_FIRST = f"""first_versions AS (SELECT user_id * 1048576 AS customer_key, user_id, email,
  full_name, {LABEL} AS city, city AS raw_city, created_at AS valid_from FROM r_users)"""
_DIM_CUSTOMER = f"""{_FIRST}, dim_customer AS (
  SELECT customer_key, user_id, email, full_name, city, valid_from,
    CASE WHEN {MOVERS.replace('city', 'raw_city')} THEN {SINCE} END AS valid_to,
    NOT {MOVERS.replace('city IN', 'coalesce(raw_city, chr(0)) IN').replace(
        'city IS', 'raw_city IS')} AS is_current FROM first_versions
  UNION ALL SELECT customer_key + 1, user_id, email, full_name,
    CASE WHEN raw_city IS NULL THEN 'City 1' ELSE concat(raw_city, ' (moved)') END,
    {SINCE}, NULL, TRUE
  FROM first_versions WHERE {MOVERS.replace('city', 'raw_city')})"""
_FCT_ORDERS = f"""parcels AS (SELECT order_id, shipped_at, delivered_at, ROW_NUMBER() OVER (
    PARTITION BY order_id ORDER BY (delivered_at IS NOT NULL) DESC, shipped_at DESC,
    shipment_id DESC) AS n FROM r_shipments),
  fct_orders AS (SELECT o.order_id AS order_key, o.order_id, customer_key,
    {DATE_ID} AS order_date_id, order_status, total_amount, discount_amount,
    CASE WHEN delivered_at >= shipped_at THEN {days('shipped_at', 'delivered_at')} END
      AS delivery_days
  FROM r_orders o JOIN dim_customer c ON o.user_id = c.user_id AND order_date >= valid_from
    AND (valid_to IS NULL OR order_date < valid_to)
  LEFT JOIN parcels s ON o.order_id = s.order_id AND s.n = 1)"""
_FCT_ITEMS = """fct_order_items AS (SELECT i.order_id, order_date_id, customer_key, product_key,
    quantity, i.unit_price, ROUND(quantity * unit_cost, 2) AS cost_amount, subtotal,
    subtotal - ROUND(quantity * unit_cost, 2) AS gross_margin
  FROM (SELECT order_id, product_id, SUM(quantity) AS quantity, MAX(unit_price) AS unit_price,
      SUM(subtotal) AS subtotal FROM r_order_items GROUP BY 1, 2) i
  JOIN fct_orders f ON i.order_id = f.order_id
  JOIN dim_product p ON i.product_id = p.product_id)"""
_STAR_ROLES = "users products categories orders order_items shipments"
_STAR = f"WITH {_DIM_DATE}, {_DIM_PRODUCT}, {_DIM_CUSTOMER}, {_FCT_ORDERS}, {_FCT_ITEMS}"


def star(columns: str, sql: str) -> str:
    return q(_STAR_ROLES, columns, f"{_STAR} {sql}")


def _star_tables() -> dict[str, str]:
    s: dict[str, str] = {}
    date_cols = ("date_id:i full_date:s year:i quarter:i month:i month_name:s day:i day_name:s "
                 "is_weekend:b")
    s["dim_date"] = star(date_cols, "SELECT * FROM dim_date")
    s["dim_date_insert"] = star(date_cols, """SELECT * REPLACE (CASE WHEN year < 1998
        THEN upper(month_name) ELSE month_name END AS month_name) FROM dim_date""")
    product = ("product_key:i product_id:i sku:s product_name:s category_name:s unit_cost:d "
               "unit_price:d")
    s["dim_product"] = star(product, "SELECT * FROM dim_product")
    s["dim_product_upsert"] = star(product, """SELECT * REPLACE (CASE WHEN category_name <
        'Brand#2' THEN concat('OLD-', sku) ELSE sku END AS sku) FROM dim_product""")
    customer = ("customer_key:i user_id:i email:s full_name:s city:s valid_from:t valid_to:t "
                "is_current:b")
    s["dim_customer_initial"] = q("users", customer, f"""WITH {_FIRST}
        SELECT customer_key, user_id, email, full_name, city, valid_from, NULL AS valid_to,
          TRUE AS is_current FROM first_versions""")
    s["dim_customer"] = star(customer, "SELECT * FROM dim_customer")
    s["rejected_customer_changes"] = q(
        "users", "user_id:i effective_at:t open_since:t reason:s",
        """SELECT user_id, CASE city WHEN 'City 0' THEN created_at
             ELSE created_at - INTERVAL 1 DAY END AS effective_at, created_at AS open_since,
             CASE city WHEN 'City 0' THEN 'same instant' ELSE 'before open version' END
             AS reason FROM r_users WHERE city IN ('City 0', 'City 1')""")
    s["star_rejects"] = q(
        "users", "user_id:i effective_at:t open_since:t reason:s",
        """SELECT user_id, created_at AS effective_at, created_at AS open_since,
             'same instant' AS reason FROM r_users WHERE city = 'City 0'""")
    s["star_change_outcomes"] = q(
        "users", "outcome:s changes:i",
        """SELECT CASE WHEN city IN ('City 1', 'City 2', 'City 3', 'City 4') OR city IS NULL
             THEN 'applied' WHEN city = 'City 0' THEN 'rejected' ELSE 'unchanged' END AS outcome,
             COUNT(*) AS changes FROM r_users
           WHERE city IS NULL OR city IN ('City 0', 'City 1', 'City 2', 'City 3', 'City 4', 'City 5')
           GROUP BY 1
           UNION ALL SELECT 'new user', COUNT(*) FROM r_users WHERE city = 'City 5'
           HAVING COUNT(*) > 0""")
    s["fct_orders"] = star(
        "order_key:i order_id:i customer_key:i order_date_id:i order_status:s total_amount:d "
        "discount_amount:d delivery_days:i", "SELECT * FROM fct_orders")
    s["incremental_load"] = s["fct_orders"]
    s["load_defaults"] = q(
        "users", "user_id:i email:s full_name:s phone:s city:s created_at:t",
        f"""SELECT user_id, email, full_name, NULL AS phone, city, {SINCE} AS created_at
            FROM r_users""")
    s["fct_order_items"] = star(
        "order_item_key:s order_id:i order_date_id:i customer_key:i product_key:i quantity:i "
        "unit_price:d cost_amount:d subtotal:d gross_margin:d",
        "SELECT *, order_id || '-' || product_key AS order_item_key FROM fct_order_items")
    s["pit_features"] = star(
        "order_id:i order_date_id:i historical_city:s customer_key:i",
        """SELECT o.order_id, order_date_id, city AS historical_city, o.customer_key
           FROM fct_orders o JOIN dim_customer c ON o.customer_key = c.customer_key""")
    s["asof_carry"] = s["pit_features"]
    moved = "concat(coalesce(raw, 'nowhere'), ' (moved)')"
    feeds = [("user_id % 3 = 0", "1998-06-01", moved), ("user_id % 6 = 0", "1997-03-01", "'Stopover'"),
             ("user_id % 5 = 0", "1996-01-01", "'Early'"), ("user_id % 5 = 0", "1999-01-01", "'Later'"),
             ("user_id % 3 = 0", "1999-06-01", moved), ("user_id % 10 = 0", "1993-05-05", "'Before'")]
    events = " UNION ALL ".join(
        f"SELECT user_id, email, full_name, {city} AS city, TIMESTAMP '{at}' AS valid_from "
        f"FROM u WHERE {condition}" for condition, at, city in feeds)
    late = f"""WITH u AS (SELECT *, city AS raw FROM r_users),
        e AS (SELECT user_id, email, full_name, {LABEL} AS city, created_at AS valid_from FROM u
          UNION ALL {events}),
        v AS (SELECT user_id, email, full_name, city, valid_from,
            LEAD(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to
          FROM (SELECT *, LAG(city) OVER (PARTITION BY user_id ORDER BY valid_from) AS old FROM e)
          WHERE city IS DISTINCT FROM old)"""
    s["scd2_late_changes"] = q(
        "users", "user_id:i email:s full_name:s city:s valid_from:t valid_to:t is_current:b",
        f"{late} SELECT *, valid_to IS NULL AS is_current FROM v")
    s["scd2_repointed_orders"] = q(
        "users orders",
        "order_id:i user_id:i order_date:t version_from:t historical_city:s",
        f"""{late} SELECT order_id, o.user_id, order_date, valid_from AS version_from,
              city AS historical_city
            FROM r_orders o LEFT JOIN v ON o.user_id = v.user_id AND order_date >= valid_from
              AND (valid_to IS NULL OR order_date < valid_to)""")
    s["scd2_history_check"] = star(
        "version_no:i is_current:b orders:i first_date_id:i last_date_id:i misplaced:i",
        f"""SELECT c.customer_key % 1048576 AS version_no, is_current, COUNT(*) AS orders,
              MIN(order_date_id) AS first_date_id, MAX(order_date_id) AS last_date_id,
              COUNT(CASE WHEN o.order_date < valid_from OR o.order_date >= valid_to THEN 1 END)
                AS misplaced
            FROM fct_orders f JOIN dim_customer c ON f.customer_key = c.customer_key
            JOIN r_orders o ON f.order_id = o.order_id GROUP BY 1, 2""")
    s["idempotence_check"] = star(
        "table_name:s rows_gained:i rows_lost:i",
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, 0 AS rows_gained, 0 AS rows_lost"
            for t in ("dim_date", "dim_product", "dim_customer", "fct_orders",
                      "fct_order_items")))
    s["sync_order_totals"] = q(
        "orders order_items", "order_id:i user_id:i order_status:s total_amount:d order_date:t",
        """SELECT o.order_id, user_id, order_status, COALESCE(line_total, total_amount)
             AS total_amount, order_date
           FROM r_orders o LEFT JOIN (SELECT order_id, SUM(subtotal) AS line_total
             FROM r_order_items GROUP BY 1) i ON o.order_id = i.order_id""")
    return s


def _pairs() -> dict[str, str]:
    s: dict[str, str] = {}
    done = "order_status = 'completed'"
    s["monthly_revenue_oltp"] = q(
        "orders", "month:s revenue:d",
        f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
            SUM(total_amount) AS revenue FROM r_orders WHERE {done} GROUP BY 1""")
    dated = "FROM fct_orders f JOIN dim_date d ON f.order_date_id = d.date_id"
    s["monthly_revenue_star"] = star(
        "year:i month:i revenue:d",
        f"SELECT year, month, SUM(total_amount) AS revenue {dated} WHERE {done} GROUP BY 1, 2")
    s["monthly_revenue_named_star"] = star(
        "year:i month_name:s revenue:d",
        f"SELECT year, month_name, SUM(total_amount) AS revenue {dated} WHERE {done} GROUP BY 1, 2")
    s["category_margin_oltp"] = q(
        "order_items products categories orders", "category_name:s gross_margin:d",
        f"""SELECT c.name AS category_name, SUM(subtotal - quantity * cost) AS gross_margin
            FROM r_order_items oi JOIN r_products p ON oi.product_id = p.product_id
            JOIN r_categories c ON p.category_id = c.category_id
            JOIN r_orders o ON oi.order_id = o.order_id WHERE {done} GROUP BY 1""")
    items = """FROM fct_order_items i JOIN dim_product p ON i.product_key = p.product_key
               JOIN fct_orders f ON i.order_id = f.order_id"""
    s["category_margin_star"] = star(
        "category_name:s gross_margin:d",
        f"SELECT category_name, SUM(gross_margin) AS gross_margin {items} WHERE {done} GROUP BY 1")
    s["weekend_split_oltp"] = q(
        "orders", "day_type:s orders:i revenue:d",
        f"""SELECT CASE WHEN isodow(order_date) IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END
              AS day_type, COUNT(*) AS orders, SUM(total_amount) AS revenue
            FROM r_orders WHERE {done} GROUP BY 1""")
    s["weekend_split_star"] = star(
        "day_type:s orders:i revenue:d",
        f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
            COUNT(*) AS orders, SUM(total_amount) AS revenue {dated} WHERE {done} GROUP BY 1""")
    s["city_revenue_hist_oltp"] = q(
        "users orders", "city:s revenue:d",
        f"""SELECT {LABEL} AS city, SUM(total_amount) AS revenue FROM r_users u
            JOIN r_orders o ON u.user_id = o.user_id WHERE {done} GROUP BY 1
            ORDER BY revenue DESC, city LIMIT 10""")
    s["city_revenue_hist_star"] = star(
        "city:s revenue:d",
        f"""SELECT city, SUM(total_amount) AS revenue FROM fct_orders f
            JOIN dim_customer c ON f.customer_key = c.customer_key WHERE {done} GROUP BY 1
            ORDER BY revenue DESC, city LIMIT 10""")
    s["top5_units_oltp"] = q(
        "order_items products orders", "product_name:s units:i",
        f"""SELECT p.name AS product_name, SUM(quantity) AS units FROM r_order_items oi
            JOIN r_products p ON oi.product_id = p.product_id
            JOIN r_orders o ON oi.order_id = o.order_id WHERE {done} GROUP BY 1
            ORDER BY units DESC, product_name LIMIT 5""")
    s["top5_units_star"] = star(
        "product_name:s units:i",
        f"""SELECT product_name, SUM(quantity) AS units {items} WHERE {done} GROUP BY 1
            ORDER BY units DESC, product_name LIMIT 5""")
    s["avg_delivery_oltp"] = q(
        "shipments", "avg_delivery_days:d",
        f"""SELECT {avg(days('shipped_at', 'delivered_at'))} AS avg_delivery_days
            FROM r_shipments WHERE delivered_at >= shipped_at""")
    s["avg_delivery_star"] = star(
        "avg_delivery_days:d", f"SELECT {avg('delivery_days')} AS avg_delivery_days "
        "FROM fct_orders WHERE delivery_days IS NOT NULL")
    s["quarterly_revenue_oltp"] = q(
        "orders", "year:i quarter:i revenue:d",
        f"""SELECT year(order_date) AS year, quarter(order_date) AS quarter,
            SUM(total_amount) AS revenue FROM r_orders WHERE {done} GROUP BY 1, 2""")
    s["quarterly_revenue_star"] = star(
        "year:i quarter:i revenue:d",
        f"SELECT year, quarter, SUM(total_amount) AS revenue {dated} WHERE {done} GROUP BY 1, 2")
    aov = f"SELECT {avg('total_amount')} AS average_order_value FROM"
    s["aov_oltp"] = q("orders", "average_order_value:d", f"{aov} r_orders WHERE {done}")
    s["aov_star"] = star("average_order_value:d", f"{aov} fct_orders WHERE {done}")
    s["top_spenders_oltp"] = q(
        "orders", "user_id:i revenue:d",
        f"""SELECT user_id, SUM(total_amount) AS revenue FROM r_orders WHERE {done} GROUP BY 1
            ORDER BY revenue DESC, user_id LIMIT 10""")
    s["top_spenders_star"] = star(
        "customer_key:i revenue:d",
        f"""SELECT customer_key, SUM(total_amount) AS revenue FROM fct_orders WHERE {done}
            GROUP BY 1 ORDER BY revenue DESC, customer_key LIMIT 10""")
    s["top_spenders_star_by_user"] = star(
        "user_id:i revenue:d",
        f"""SELECT user_id, SUM(total_amount) AS revenue FROM fct_orders f
            JOIN dim_customer c ON f.customer_key = c.customer_key WHERE {done}
            GROUP BY 1 ORDER BY revenue DESC, user_id LIMIT 10""")
    s["category_items_oltp"] = q(
        "order_items products categories", "category_name:s items:i",
        """SELECT c.name AS category_name, COUNT(item_id) AS items FROM r_order_items oi
           JOIN r_products p ON oi.product_id = p.product_id
           JOIN r_categories c ON p.category_id = c.category_id GROUP BY 1""")
    s["category_items_star"] = star(
        "category_name:s items:i",
        """SELECT category_name, COUNT(*) AS items FROM fct_order_items i
           JOIN dim_product p ON i.product_key = p.product_key GROUP BY 1""")
    return s


def _layouts() -> dict[str, str]:
    month = ">= TIMESTAMP '1998-11-01' AND {c} < TIMESTAMP '1998-12-01'"
    s: dict[str, str] = {}
    s["orders_month_status"] = q(
        "orders", "order_id:i user_id:i total_amount:d order_date:t",
        f"""SELECT order_id, user_id, total_amount, order_date FROM r_orders WHERE order_date
            {month.format(c='order_date')} AND order_status = 'completed'""")
    s["product_sales_point"] = q(
        "order_items", "product_id:i total_sales:d",
        """SELECT product_id, SUM(subtotal) AS total_sales FROM r_order_items
           WHERE product_id = 42 GROUP BY 1""")
    s["payments_in_month"] = q(
        "payments", "payments:i",
        f"""SELECT COUNT(*) AS payments FROM r_payments WHERE payment_date
            {month.format(c='payment_date')}""")
    s["payments_in_month_by_function"] = q(
        "payments", "payments:i",
        """SELECT COUNT(*) AS payments FROM r_payments
           WHERE date_trunc('month', payment_date) = TIMESTAMP '1998-11-01'""")
    s["returned_orders"] = q(
        "orders", "order_id:i user_id:i total_amount:d",
        """SELECT order_id, user_id, total_amount FROM r_orders
           WHERE order_status = 'returned'""")
    s["carrier_shipments"] = q(
        "shipments", "tracking_number:s carrier:s shipment_status:s",
        """SELECT tracking_number, carrier, shipment_status FROM r_shipments
           WHERE carrier = 'Carrier D'""")
    s["payments_successful"] = q(
        "payments", "payment_id:i order_id:i payment_method:s payment_status:s amount:d "
        "payment_date:t", "SELECT * FROM r_payments WHERE payment_status = 'successful'")
    user = "user_id:i email:s full_name:s phone:s city:s created_at:t"
    s["user_by_email_ci"] = q("users", user, """SELECT * FROM r_users
        WHERE lower(email) = 'customer#000000042@example.com'""")
    s["csv_bulk_load"] = q("users", user, "SELECT * FROM r_users")
    s["parquet_reload"] = q("coupons", "coupon_id:i code:s discount_pct:d",
                            "SELECT coupon_id, code, discount_pct FROM r_coupons")
    return s


def _audits() -> dict[str, str]:
    from shopgrain.sources import schemas as m

    s: dict[str, str] = {}
    verdict = "table_name:s rule:s violations:i sample_key:s"
    everything = " ".join(m.SHOP_DDL)

    def union(parts: list[str]) -> str:
        return " UNION ALL ".join(parts)

    def unique(table: str, name: str, key: tuple, rule: str = "") -> str:
        cols = ", ".join(key)
        text = "concat_ws('/', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in key) + ")"
        present = " AND ".join(f"{c} IS NOT NULL" for c in key)
        return f"""SELECT '{name}' AS table_name, '{rule or f"unique({cols})"}' AS rule,
            COUNT(*) AS violations, MIN({text}) AS sample_key
            FROM (SELECT {cols} FROM {table} WHERE {present} GROUP BY {cols}
            HAVING COUNT(*) > 1)"""

    def row_rule(table: str, name: str, key: str, rule: str, bad: str) -> str:
        label = rule.replace("'", "''")
        return f"""SELECT '{name}' AS table_name, '{label}' AS rule, COUNT(*) AS violations,
            MIN(CAST({key} AS VARCHAR)) AS sample_key FROM {table} WHERE {bad}"""

    s["audit_unique"] = q(everything, verdict, union(
        [unique(f"r_{t}", t, k) for t, keys in m.UNIQUE_KEYS.items() for k in keys]))
    parts = []
    for table, ddl in m.SHOP_DDL.items():
        for name in [p.split()[0] for p in ddl.split(", ")]:
            if name not in m.NULLABLE.get(table, set()):
                parts.append(row_rule(f"r_{table}", table, m.UNIQUE_KEYS[table][0][0],
                                      f"{name} IS NOT NULL", f"{name} IS NULL"))
    s["audit_not_null"] = q(everything, verdict, union(parts))
    for key, rules in (("audit_domains", m.DOMAINS), ("audit_cross_column", m.CROSS_COLUMN)):
        s[key] = q(" ".join(rules), verdict, union(
            [row_rule(f"r_{t}", t, m.UNIQUE_KEYS[t][0][0], rule, f"NOT ({rule})")
             for t, texts in rules.items() for rule in texts]))
    s["audit_foreign_keys"] = q(everything, verdict, union(
        [f"""SELECT '{fk.table}' AS table_name, '{fk.column} references {fk.parent}' AS rule,
             COUNT(*) AS violations, MIN(CAST({fk.column} AS VARCHAR)) AS sample_key
             FROM r_{fk.table} c WHERE {fk.column} IS NOT NULL AND NOT EXISTS
             (SELECT 1 FROM r_{fk.parent} p WHERE p.{fk.parent_column} = c.{fk.column})"""
         for fk in m.FOREIGN_KEYS]))
    gone = "(SELECT user_id FROM r_users WHERE phone IS NULL)"
    doomed = f"(SELECT order_id FROM r_orders WHERE user_id IN {gone})"
    coupon = "(SELECT coupon_id FROM r_coupons WHERE discount_pct = 25)"

    def reach(table: str, action: str, where: str) -> str:
        return f"""SELECT '{table}' AS table_name, '{action}' AS action,
            COUNT(*) AS rows_affected FROM r_{table} WHERE {where}"""

    s["cascade_plan"] = q(
        "users coupons orders order_items payments shipments reviews",
        "table_name:s action:s rows_affected:i", union([
            reach("users", "delete", "phone IS NULL"),
            reach("orders", "delete", f"user_id IN {gone}"),
            reach("order_items", "delete", f"order_id IN {doomed}"),
            reach("payments", "delete", f"order_id IN {doomed}"),
            reach("shipments", "delete", f"order_id IN {doomed}"),
            reach("reviews", "delete", f"user_id IN {gone}"),
            reach("coupons", "delete", "discount_pct = 25"),
            reach("orders", "set coupon_id null",
                  f"user_id NOT IN {gone} AND coupon_id IN {coupon}"),
        ]))

    def fanout(name: str, left: str, right: str, on: tuple) -> str:
        cols = ", ".join(on)
        text = "concat_ws('/', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in on) + ")"
        return f"""SELECT '{name}' AS join_name, SUM(l) AS rows_before,
              SUM(l * COALESCE(r, 0)) AS rows_after, MAX(r) AS max_matches_per_key,
              SUM(CASE WHEN r IS NULL THEN l ELSE 0 END) AS rows_unmatched,
              (array_agg(k ORDER BY l * COALESCE(r, 0) DESC, k))[1] AS top_key
            FROM (SELECT {text} AS k, l, r FROM (SELECT {cols}, COUNT(*) AS l FROM {left}
              GROUP BY {cols}) LEFT JOIN (SELECT {cols}, COUNT(*) AS r FROM {right}
              GROUP BY {cols}) USING ({cols}))"""

    s["join_fanout_report"] = star(
        "join_name:s rows_before:i rows_after:i max_matches_per_key:i rows_unmatched:i top_key:s",
        union([
            fanout("orders to shipments: non-unique right key", "r_orders", "r_shipments",
                   ("order_id",)),
            fanout("lines to lines: half of the key", "r_order_items", "r_order_items",
                   ("order_id",)),
            fanout("lines to lines: whole key", "r_order_items", "r_order_items",
                   ("order_id", "product_id")),
            fanout("orders to customers: whole history", "r_orders", "dim_customer",
                   ("user_id",)),
            fanout("orders to customers: current version", "r_orders",
                   "(SELECT * FROM dim_customer WHERE is_current)", ("user_id",)),
        ]))
    s["scd2_audit"] = star(verdict, union([
        row_rule("""(SELECT *, LEAD(valid_from) OVER (PARTITION BY user_id
                 ORDER BY valid_from, customer_key) AS nf FROM dim_customer)""", "dim_customer",
                 "customer_key", "no overlapping versions",
                 "nf IS NOT NULL AND (valid_to IS NULL OR nf < valid_to)"),
        row_rule("dim_customer", "dim_customer", "customer_key", "no empty interval",
                 "valid_to <= valid_from"),
        row_rule("dim_customer", "dim_customer", "customer_key", "is_current means open",
                 "is_current <> (valid_to IS NULL)"),
        unique("(SELECT user_id FROM dim_customer WHERE valid_to IS NULL)", "dim_customer",
               ("user_id",), "one open version per user"),
    ]))
    s["star_audit_unique"] = star(verdict, union([
        unique(table, table, key) for table, key in (
            ("dim_date", ("date_id",)), ("dim_date", ("full_date",)),
            ("dim_customer", ("customer_key",)), ("dim_product", ("product_key",)),
            ("dim_product", ("product_id",)), ("fct_orders", ("order_key",)),
            ("fct_orders", ("order_id",)), ("fct_order_items", ("order_id", "product_key")))
    ] + ["""SELECT 'fct_order_items' AS table_name, 'unique(order_item_key)' AS rule,
            COUNT(*) AS violations, MIN(k) AS sample_key FROM (
            SELECT order_id || '-' || product_key AS k FROM fct_order_items
            GROUP BY 1 HAVING COUNT(*) > 1)"""]))
    required = {
        "dim_date": ("date_id", "full_date year quarter month month_name day day_name is_weekend"),
        "dim_customer": ("customer_key", "user_id email full_name valid_from is_current"),
        "dim_product": ("product_key",
                        "product_id sku product_name category_name unit_cost unit_price"),
        "fct_orders": ("order_key", "order_id customer_key order_date_id order_status "
                                    "total_amount discount_amount"),
        "fct_order_items": ("order_id || '-' || product_key",
                            "order_id order_date_id customer_key product_key quantity unit_price "
                            "cost_amount subtotal gross_margin"),
    }
    s["star_audit_not_null"] = star(verdict, union([
        f"""SELECT '{table}' AS table_name, '{name} IS NOT NULL' AS rule,
              COUNT(*) - COUNT({column}) AS violations,
              MIN(CASE WHEN {column} IS NULL THEN CAST({key} AS VARCHAR) END) AS sample_key
            FROM {table}"""
        for table, (key, names) in required.items()
        for name, column in [("order_item_key" if "||" in key else key, key),
                             *((n, n) for n in names.split())]
    ]))
    s["star_audit_foreign_keys"] = star(verdict, union([
        f"""SELECT '{table}' AS table_name, '{column} references {parent}' AS rule,
              COUNT(*) AS violations, MIN(CAST({column} AS VARCHAR)) AS sample_key
            FROM {table} WHERE {column} IS NOT NULL
              AND {column} NOT IN (SELECT {key} FROM {parent})"""
        for table, column, parent, key in (
            ("fct_orders", "customer_key", "dim_customer", "customer_key"),
            ("fct_orders", "order_date_id", "dim_date", "date_id"),
            ("fct_order_items", "order_date_id", "dim_date", "date_id"),
            ("fct_order_items", "customer_key", "dim_customer", "customer_key"),
            ("fct_order_items", "product_key", "dim_product", "product_key"))
    ]))
    s["table_counts"] = q(everything, "table_name:s row_count:i", union(
        [f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM r_{t}" for t in m.SHOP_DDL]))
    s["orders_per_each_user"] = q(
        "users orders", "user_id:i order_count:i joined_row_count:i",
        """SELECT u.user_id, COUNT(order_id) AS order_count, COUNT(*) AS joined_row_count
           FROM r_users u LEFT JOIN r_orders o ON u.user_id = o.user_id GROUP BY 1""")
    s["profile_nulls"] = q(
        "users", "column_name:s row_count:i null_count:i null_pct:d",
        union([f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count,
                COUNT(*) - COUNT({c}) AS null_count,
                {pct(f'(COUNT(*) - COUNT({c}))', 'COUNT(*)')} AS null_pct FROM r_users"""
               for c in ("phone", "city")]))
    top = "SUM(CASE WHEN rn <= floor(n * 0.2) THEN units ELSE 0 END)"
    s["profile_pareto"] = q(
        "order_items", "products:i top_products:i units:i top_units:i top_units_pct:d",
        f"""WITH u AS (SELECT product_id, SUM(quantity) AS units FROM r_order_items GROUP BY 1),
            r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY units DESC, product_id) AS rn,
              COUNT(*) OVER () AS n FROM u)
            SELECT COUNT(*) AS products, COUNT(CASE WHEN rn <= floor(n * 0.2) THEN 1 END)
              AS top_products, SUM(units) AS units, {top} AS top_units,
              {pct(top, 'SUM(units)')} AS top_units_pct FROM r""")
    s["profile_seasonality"] = q(
        "orders", "day_of_year:i orders:i orders_pct:d",
        f"""SELECT dayofyear(order_date) AS day_of_year, COUNT(*) AS orders,
            {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS orders_pct FROM r_orders GROUP BY 1""")
    s["profile_mix"] = q(
        "orders payments reviews", "column_name:s value:s row_count:i row_pct:d",
        union([f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value,
                COUNT(*) AS row_count, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS row_pct
                FROM r_{t} GROUP BY {c}"""
               for t, c in (("orders", "order_status"), ("payments", "payment_method"),
                            ("reviews", "rating"))]))
    return s


def _report(found: dict[str, str]) -> str:
    """The first rows of every question in report order, each as its sorted fields."""
    from shopgrain.plans.catalogue import catalogue

    parts = []
    for c in catalogue():
        keep = min(10, c.limit or 10)
        terms = [f"{name} {'DESC NULLS FIRST' if way else 'ASC NULLS LAST'}"
                 for name, _, way in (term.partition(" ") for term in c.order)]
        order = f"ORDER BY {', '.join(terms)}" if terms else ""
        number = "TRY_CAST(v AS DOUBLE)"
        shown = (f"k || '=' || COALESCE(CAST(CAST(round({number} * 100) AS BIGINT) AS VARCHAR), v, "
                 "'NULL')")
        parts.append(f"""SELECT {c.number} AS question_id, '{c.name}' AS name, p AS position,
            string_agg({shown}, '|' ORDER BY {shown}) AS fields
          FROM (SELECT p, CAST(COLUMNS(* EXCLUDE (p)) AS VARCHAR) FROM (
              SELECT row_number() OVER ({order}) AS p, * FROM ({found[c.name]}) AS a) AS b
            WHERE p <= {keep}) AS s UNPIVOT INCLUDE NULLS (v FOR k IN (COLUMNS(* EXCLUDE (p))))
          GROUP BY p""")
    union = " UNION ALL ".join(parts)
    return q("categories", "question_id:i name:s position:i fields:s", union)


def all_sql() -> dict[str, str]:
    found = {**_questions(), **_trips(), **_star_tables(), **_pairs(), **_layouts(), **_audits()}
    found["question_report"] = _report(found)
    return found
