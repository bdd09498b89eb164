"""The fifty numbered questions, with the order and row limit each has in the printed report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.plans import questions as q
from shopgrain.sources.tables import Shop

RFM_AS_OF = "2026-01-01 00:00:00"


@dataclass(frozen=True)
class Question:
    number: int
    name: str
    title: str
    build: Callable[[Shop], DataFrame]
    order: list[str] = field(default_factory=list)
    limit: int | None = None
    # What several questions have in common, and how this one goes on from it.
    common: Callable[[Shop], DataFrame] | None = None
    from_common: Callable[[DataFrame], DataFrame] | None = None

    def order_by(self) -> list[Column]:
        """Sort columns; NULL counts as the largest value."""
        terms = [term.partition(" ") for term in self.order]
        return [
            F.col(name).desc_nulls_first() if way else F.col(name).asc_nulls_last()
            for name, _, way in terms
        ]

    def report(self, shop: Shop, rows: int = 10, made: DataFrame | None = None) -> DataFrame:
        """The first rows in report order; a bounded top-k, never a full sort.

        `made` is what `common` gives, where it has been computed already.
        """
        df = self.build(shop) if made is None else self.from_common(made)
        keep = rows if self.limit is None else min(rows, self.limit)
        return df.orderBy(*self.order_by()).limit(keep) if self.order else df.limit(keep)


def _category_totals(shop: Shop) -> DataFrame:
    return q.category_totals(shop.order_items, shop.products)


def catalogue(
    rfm_as_of: str = RFM_AS_OF, min_orders: int = 50, min_reviews: int = 20
) -> list[Question]:
    entries = [
        Question(1, "cohort_retention", "Monthly cohort retention",
                 lambda s: q.cohort_retention(s.orders), ["cohort_month", "month_offset"], 10),
        Question(2, "rfm_segments", "Recency, frequency and monetary segments",
                 lambda s: q.rfm_segments(s.orders, rfm_as_of), ["monetary desc", "user_id"],
                 10),
        Question(3, "moving_avg_7", "Seven-day moving average per product",
                 lambda s: q.moving_avg_7(s.order_items, s.orders, s.products),
                 ["product_id", "sale_date"], 10),
        Question(4, "purchase_streaks", "Runs of consecutive purchase days",
                 lambda s: q.purchase_streaks(s.orders),
                 ["streak_length_days desc", "streak_start", "user_id"], 10),
        Question(5, "top3_per_category", "Best three products of each category",
                 lambda s: q.top3_per_category(s.categories, s.products, s.order_items, s.orders),
                 ["category_name", "rank_in_category", "product_name"], 12),
        Question(6, "mom_growth", "Month-over-month revenue growth",
                 lambda s: q.mom_growth(s.orders), ["sales_month"]),
        Question(7, "order_funnel", "Order, payment and delivery funnel",
                 lambda s: q.order_funnel(s.orders, s.payments, s.shipments)),
        Question(8, "coupon_margin", "Margin with and without coupon",
                 lambda s: q.coupon_margin(s.orders, s.order_items, s.products),
                 ["sales_channel"]),
        Question(9, "second_order_gap", "Days from first to second order",
                 lambda s: q.second_order_gap(s.orders)),
        Question(10, "repeat_purchase_rate", "Products bought again by the same user",
                 lambda s: q.repeat_purchase_rate(s.order_items, s.orders)),
        Question(11, "payment_success", "Payment methods and success rates",
                 lambda s: q.payment_success(s.payments), ["total_tx desc", "payment_method"]),
        Question(12, "carrier_delivery_days", "Mean delivery days per carrier",
                 lambda s: q.carrier_delivery_days(s.shipments),
                 ["avg_delivery_days", "carrier"]),
        Question(13, "delivery_anomalies", "Shipments delivered before they left",
                 lambda s: q.delivery_anomalies(s.shipments), ["shipment_id"], 5),
        Question(14, "city_revenue", "Orders and revenue per city",
                 lambda s: q.city_revenue(s.users, s.orders), ["total_revenue desc", "city"],
                 10),
        Question(15, "return_rate_products", "Products cancelled or returned most",
                 lambda s: q.return_rate_products(s.products, s.order_items, s.orders,
                                                  min_orders),
                 ["return_rate_pct desc", "product_id"], 5),
        Question(16, "order_value_profile", "Mean, median and largest order value",
                 lambda s: q.order_value_profile(s.orders)),
        Question(17, "top_rated_products", "Best rated products",
                 lambda s: q.top_rated_products(s.products, s.reviews, min_reviews),
                 ["avg_rating desc", "review_count desc", "product_id"], 10),
        Question(18, "lowest_rated_products", "Worst rated or unrated products",
                 lambda s: q.lowest_rated_products(s.products, s.reviews),
                 ["avg_rating", "review_count", "product_id"], 5),
        Question(19, "orders_by_weekday", "Orders per day of week",
                 lambda s: q.orders_by_weekday(s.orders), ["day_of_week"]),
        Question(20, "orders_by_hour", "Orders per hour",
                 lambda s: q.orders_by_hour(s.orders), ["order_hour"]),
        Question(21, "top_outflow_products", "Products leaving stock fastest",
                 lambda s: q.top_outflow_products(s.products, s.inventory_movements),
                 ["total_outflow desc", "product_id"], 10),
        Question(22, "inflow_by_reason", "Stock received per reason",
                 lambda s: q.inflow_by_reason(s.inventory_movements),
                 ["total_quantity desc", "reference_reason"]),
        Question(23, "largest_lines", "Largest order lines",
                 lambda s: q.largest_lines(s.order_items, s.products),
                 ["quantity desc", "subtotal desc", "order_id"], 10),
        Question(24, "days_to_first_order", "Days from registration to first order",
                 lambda s: q.days_to_first_order(s.users, s.orders)),
        Question(25, "inactive_users", "Users without orders",
                 lambda s: q.inactive_users(s.users, s.orders)),
        Question(26, "top_coupons", "Most used coupons",
                 lambda s: q.top_coupons(s.coupons, s.orders), ["times_used desc", "code"], 5),
        Question(27, "split_shipments", "Orders sent in several parcels",
                 lambda s: q.split_shipments(s.shipments), ["order_id"], 5),
        Question(28, "orders_per_user", "Mean orders per user",
                 lambda s: q.orders_per_user(s.users, s.orders)),
        Question(29, "lowest_margin_products", "Products with the lowest margin",
                 lambda s: q.lowest_margin_products(s.products),
                 ["margin_pct", "product_id"], 5),
        Question(30, "highest_margin_products", "Products with the highest margin",
                 lambda s: q.highest_margin_products(s.products),
                 ["margin_pct desc", "product_id"], 5),
    ]
    # Fixed value: how many categories each of these questions names.
    for number in range(31, 51):
        k = number % 5 + 3
        entries.append(Question(
            number, f"category_sales_top{k}", f"Sales of the best {k} categories",
            lambda s, k=k: q.category_sales(s.order_items, s.products, k),
            ["revenue desc", "category_id"], k,
            _category_totals, lambda totals, k=k: q.best_categories(totals, k),
        ))
    return entries
