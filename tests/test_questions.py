"""Hand-made frames for the semantics that the big tables do not reach."""

from datetime import date, datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shopgrain import functions as fn
from shopgrain.operators.joins import join_size, not_exists, not_in
from shopgrain.plans import questions as q, trips

ORDERS = ("order_id INT, user_id INT, coupon_id INT, order_status STRING, "
          "total_amount DECIMAL(12,2), order_date TIMESTAMP_NTZ")


def orders(spark, *specs):
    """(user, timestamp[, amount[, status]]) per order."""
    from decimal import Decimal

    data = [(i, s[0], None, s[3] if len(s) > 3 else "completed",
             Decimal(s[2] if len(s) > 2 else "10.00"), s[1]) for i, s in enumerate(specs)]
    return spark.createDataFrame(data, ORDERS)


def test_streaks(spark):
    df = orders(spark, (1, dt(2024, 1, 1)), (2, dt(2024, 1, 30)), (2, dt(2024, 1, 31, 5)),
                (2, dt(2024, 1, 31, 9)), (2, dt(2024, 2, 1)), (2, dt(2024, 2, 2)),
                (2, dt(2024, 2, 5)), (2, dt(2024, 2, 6), "1", "returned"), (3, None))
    assert rows(q.purchase_streaks(df)) == [(2, date(2024, 1, 30), date(2024, 2, 2), 4)]


def test_growth_over_zero_and_missing_month(spark):
    df = orders(spark, (1, dt(2024, 1, 3), "0.00"), (1, dt(2024, 2, 3), "80.00"),
                (1, dt(2024, 4, 3), "20.00"))
    got = [r[4] for r in q.mom_growth(df).orderBy("sales_month").collect()]
    assert got == [None, None, -75.0]


def test_growth_of_a_single_month(spark):
    assert q.mom_growth(orders(spark, (1, dt(2024, 1, 3)))).first()["mom_growth_pct"] is None


def test_second_order_gap_with_tied_times_and_single_buyers(spark):
    df = orders(spark, (1, dt(2024, 1, 1, 23)), (1, dt(2024, 1, 2, 22)), (1, dt(2024, 5, 1)),
                (2, dt(2024, 1, 1)), (2, dt(2024, 1, 1)), (3, dt(2024, 1, 1)),
                (4, dt(2024, 1, 1)), (4, dt(2024, 1, 8)))
    assert rows(q.second_order_gap(df)) == [(3, 2.33, 0.0)]
    assert rows(q.second_order_gap(df.where("user_id = 3"))) == [(0, None, None)]


def test_cohort_offset_zero_is_always_whole(shop):
    cohorts = q.cohort_retention(shop.orders)
    assert cohorts.where("month_offset = 0 AND retention_pct <> 100.0").count() == 0
    assert cohorts.where("month_offset = 0").count() == cohorts.select("cohort_month") \
        .distinct().count()


def test_not_in_and_not_exists(spark):
    x = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    with_null = spark.createDataFrame([(1,), (None,)], "k INT")
    plain = spark.createDataFrame([(1,)], "k INT")
    assert rows(not_in(x, with_null, "k")) == []
    assert rows(not_in(x, plain, "k")) == [(2,)]
    assert rows(not_in(x, plain.where("k > 5"), "k")) == [(None,), (1,), (2,)]
    assert rows(not_exists(x, with_null, "k")) == [(None,), (2,)]


def test_not_in_equals_sql(spark):
    for name, values in {"l": "(1),(2),(NULL)", "r": "(2),(3)"}.items():
        spark.sql(f"SELECT * FROM VALUES {values} AS t(k)").createOrReplaceTempView(name)
    sql = spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)")
    assert rows(not_in(spark.table("l"), spark.table("r"), "k")) == rows(sql)


def test_join_size_equals_the_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c")], "k INT, p STRING")
    right = spark.createDataFrame([(1, "a"), (1, "a"), (1, "z"), (2, "a")], "k INT, p STRING")
    half = join_size(left, right, ["k"]).first()
    assert half.rows_after == left.join(right, "k").count() == 7
    assert (half.rows_before, half.max_matches_per_key, half.rows_unmatched) == (4, 3, 1)
    assert half.top_key == "1"
    whole = join_size(left, right, ["k", "p"]).first()
    assert whole.rows_after == left.join(right, ["k", "p"]).count() == 3


def test_zero_price_has_no_margin(spark):
    products = spark.sql("""SELECT * FROM VALUES (1, 'a', 0.00BD, 1.00BD), (2, 'b', 4.00BD,
        1.00BD) AS t(product_id, name, price, cost)""")
    assert [r.product_id for r in q.lowest_margin_products(products).collect()] == [2, 1]


MINUTE_CASES = [
    (dt(2024, 1, 1, 10, 0, 59), dt(2024, 1, 1, 10, 1, 1), 1),
    (dt(2024, 1, 1, 10, 0, 0), dt(2024, 1, 1, 10, 9, 59), 9),
    (dt(2024, 1, 1, 10, 0, 0, 500000), dt(2024, 1, 1, 10, 1, 0, 250000), 1),
    (dt(2024, 1, 1, 23, 59, 59, 999999), dt(2024, 1, 2), 1),
    (dt(2024, 1, 1, 10, 1, 1), dt(2024, 1, 1, 10, 0, 59), -1),
    (dt(2024, 3, 31, 1, 30), dt(2024, 3, 31, 3, 30), 120),
    (dt(2024, 1, 1), None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_minute_crossings_in_any_zone(spark, zone):
    df = spark.createDataFrame(MINUTE_CASES, "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ, want BIGINT")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = df.select(fn.minute_crossings(F.col("a"), F.col("b")).alias("m"), "want").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.m for r in got] == [r.want for r in got]


def test_duration_bands(spark):
    start = dt(2024, 1, 1, 8)
    ends = [dt(2024, 1, 1, 8, 9, 59), dt(2024, 1, 1, 8, 10), dt(2024, 1, 1, 8, 30),
            dt(2024, 1, 1, 8, 30, 1), None, dt(2024, 1, 1, 7, 50)]
    df = spark.createDataFrame([(start, e, 10.0) for e in ends],
                               "pickup_at TIMESTAMP_NTZ, dropoff_at TIMESTAMP_NTZ, "
                               "total_amount DOUBLE")
    by_boundary = {r.trip_type: r.trips for r in trips.duration_bands(df).collect()}
    assert by_boundary == {trips.SHORT: 2, trips.MEDIUM: 3, trips.LONG: 1}
    exact = {r.trip_type: r.trips for r in trips.duration_bands_strict(df).collect()}
    assert exact == {trips.SHORT: 3, trips.MEDIUM: 1, trips.LONG: 1}


def test_whole_days_counts_24_hours(spark):
    df = spark.createDataFrame([(dt(2024, 1, 1, 23), dt(2024, 1, 2, 22)),
                                (dt(2024, 1, 1, 1), dt(2024, 1, 2, 1)),
                                (dt(2024, 1, 3, 1), dt(2024, 1, 1, 0))],
                               "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert [r[0] for r in df.select(fn.whole_days(F.col("a"), F.col("b"))).collect()] \
        == [0, 1, -2]


def test_round_half_away_from_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (1.125D), (-1.125D), (0.004D), (-0.001D) AS t(x)")
    assert [r[0] for r in df.select(fn.round2(F.col("x"))).collect()] == [1.13, -1.13, 0.0, 0.0]


def test_moving_average_rows_against_days(spark):
    from decimal import Decimal

    days = [date(2024, 1, d) for d in (1, 2, 20, 21, 22, 23, 24, 25, 26)]
    df = orders(spark, *[(1, dt(d.year, d.month, d.day)) for d in days])
    lines = spark.createDataFrame([(i, 7, i + 1, Decimal(i + 1)) for i in range(len(days))],
                                  "order_id INT, product_id INT, quantity INT, "
                                  "subtotal DECIMAL(12,2)")
    products = spark.createDataFrame([(7, "p")], "product_id INT, name STRING")
    by_rows = [r.moving_avg_qty_7d for r in
               q.moving_avg_7(lines, df, products).orderBy("sale_date").collect()]
    by_days = [r.moving_avg_qty_7d for r in
               q.moving_avg_7_calendar(lines, df, products).orderBy("sale_date").collect()]
    assert by_rows == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0]
    assert by_days == [1.0, 1.5, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0]
