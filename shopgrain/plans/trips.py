"""Ten questions asked of one trips file.

Where the SQL and the dataframe wording of a question differ in meaning, the SQL meaning is the
plain function and the dataframe meaning the `_strict` one. Money and distance are summed as
decimals of SOURCE_SCALE places and ratios as decimals of RATIO_SCALE, because a sum of doubles
changes with the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import elapsed_seconds, minute_crossings, round_to

SHORT, MEDIUM, LONG = "short (<10 min)", "medium (10-30 min)", "long (>30 min)"


SOURCE_SCALE = 6   # decimal places that amounts and distances of the source may have
RATIO_SCALE = 12   # places kept of a ratio of one row


def _sum(name: str) -> Column:
    return F.sum(F.col(name).cast(f"decimal(28,{SOURCE_SCALE})"))


def _rows() -> Column:
    return F.count(F.lit(1)).alias("trips")


def _mean(name: str) -> Column:
    return round_to(_sum(name).cast("double") / F.nullif(F.count(name), F.lit(0)), 4)


def _mean_ratio(x: Column) -> Column:
    total = F.sum(x.cast(f"decimal(28,{RATIO_SCALE})"))
    return total.cast("double") / F.nullif(F.count(x), F.lit(0))


def _boundary_minutes() -> Column:
    return minute_crossings(F.col("pickup_at"), F.col("dropoff_at"))


def _true_minutes() -> Column:
    return elapsed_seconds(F.col("pickup_at"), F.col("dropoff_at")) / 60.0


def trip_totals(trips: DataFrame) -> DataFrame:
    return trips.agg(_rows(), _mean("total_amount").alias("avg_total"))


def by_passengers(trips: DataFrame) -> DataFrame:
    """Trips and mean distance per passenger count; unknown counts form a group."""
    return trips.groupBy("passenger_count").agg(
        _rows(), _mean("trip_distance").alias("avg_distance")
    )


def by_passengers_strict(trips: DataFrame) -> DataFrame:
    """As `by_passengers`, without the unknown group, counting known distances."""
    return trips.where(F.col("passenger_count").isNotNull()).groupBy("passenger_count").agg(
        F.count("trip_distance").alias("trips"), _mean("trip_distance").alias("avg_distance")
    )


def revenue_by_payment(trips: DataFrame) -> DataFrame:
    return trips.groupBy("payment_type").agg(_sum("total_amount").alias("revenue"))


def _tip_rates(trips: DataFrame, min_trips: int, k: int) -> DataFrame:
    rate = F.col("tip_amount") / F.nullif(F.col("total_amount"), F.lit(0.0))
    return (
        trips.groupBy("pu_location_id")
        .agg(round_to(_mean_ratio(rate), 6).alias("tip_rate"), _rows())
        .where(F.col("trips") > min_trips)
        .select("pu_location_id", "tip_rate")
        .orderBy(F.col("tip_rate").desc_nulls_last(), "pu_location_id")
        .limit(k)
    )


def tip_rate_zones(trips: DataFrame, min_trips: int = 1000, k: int = 5) -> DataFrame:
    """Zones with the best mean tip rate; free trips count as trips but have no rate."""
    return _tip_rates(trips, min_trips, k)


def tip_rate_zones_strict(trips: DataFrame, min_trips: int = 1000, k: int = 5) -> DataFrame:
    """As `tip_rate_zones`, over trips with a positive total only."""
    return _tip_rates(trips.where(F.col("total_amount") > 0), min_trips, k)


def pickups_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.hour("pickup_at").alias("pickup_hour")).agg(_rows())


def long_trips(trips: DataFrame, over: float = 20.0) -> DataFrame:
    return trips.where(F.col("trip_distance") > over).agg(
        _rows(), _mean("total_amount").alias("avg_total")
    )


def nonpositive_totals(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("total_amount") <= 0).agg(_rows())


def _fastest(trips: DataFrame, minutes: Column, min_trips: int, k: int) -> DataFrame:
    speed = F.col("trip_distance") / F.nullif(F.col("minutes").cast("double"), F.lit(0.0))
    return (
        trips.select("pu_location_id", "do_location_id", "trip_distance",
                     minutes.alias("minutes"))
        .where(F.col("minutes").between(5, 120))
        .groupBy("pu_location_id", "do_location_id")
        .agg(round_to(_mean_ratio(speed) * 60.0, 4).alias("avg_mph"), _rows())
        .where(F.col("trips") > min_trips)
        .select("pu_location_id", "do_location_id", "avg_mph")
        .orderBy(F.col("avg_mph").desc(), "pu_location_id", "do_location_id")
        .limit(k)
    )


def fastest_pairs(trips: DataFrame, min_trips: int = 100, k: int = 5) -> DataFrame:
    """Zone pairs with the highest mean speed, minutes counted as boundaries crossed."""
    return _fastest(trips, _boundary_minutes(), min_trips, k)


def fastest_pairs_strict(trips: DataFrame, min_trips: int = 100, k: int = 5) -> DataFrame:
    """As `fastest_pairs`, on the exact fractional minutes."""
    return _fastest(trips, _true_minutes(), min_trips, k)


def airport_fees(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("airport_fee") > 0).agg(
        _rows(), _sum("airport_fee").alias("fees")
    )


def duration_bands(trips: DataFrame) -> DataFrame:
    """Trips per band of boundary minutes; a trip without an end falls in the last band."""
    m = _boundary_minutes()
    band = F.when(m < 10, SHORT).when(m <= 30, MEDIUM).otherwise(LONG)
    return trips.groupBy(band.alias("trip_type")).agg(
        _rows(), _mean("total_amount").alias("avg_total")
    )


def duration_bands_strict(trips: DataFrame) -> DataFrame:
    """Trips per right-closed band of exact minutes; a trip without an end is left out."""
    timed = trips.select("total_amount", _true_minutes().alias("m")).where("m IS NOT NULL")
    m = F.col("m")
    band = F.when(m <= 10, SHORT).when(m <= 30, MEDIUM).otherwise(LONG)
    return timed.groupBy(band.alias("trip_type")).agg(
        F.count("total_amount").alias("trips"), _mean("total_amount").alias("avg_total")
    )
