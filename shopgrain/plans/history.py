"""A customer history that takes late changes, and the orders that point into it.

Three stored tables: the change events, the versions that follow from them, and the orders with the
version in force when they were placed, named by user and start. A feed rebuilds the users it
touches and re-points the orders that lie in versions it has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.operators.carry import as_of_carry
from shopgrain.operators.joins import label_null
from shopgrain.operators.timeline import distinct_events, repoint, splice, timeline
from shopgrain.plans.questions import UNKNOWN_CITY
from shopgrain.plans.star import FIRST_SEEN, TRACKED
from shopgrain.sources.versions import VersionedTables

KEY, AT = "user_id", "effective_at"
POINTS = {"version_from": "valid_from", "historical_city": "city"}


def first_events(users: DataFrame) -> DataFrame:
    """The first event of each user: as registered."""
    return labelled(users.withColumn(AT, F.col(FIRST_SEEN)))


def labelled(feed: DataFrame) -> DataFrame:
    city = label_null(F.col("city"), UNKNOWN_CITY).alias("city")
    return feed.select(KEY, *[city if c == "city" else F.col(c) for c in TRACKED], AT)


def start_history(users: DataFrame, orders: DataFrame, tables: VersionedTables) -> None:
    events = tables.write("customer_events", distinct_events(
        first_events(users), KEY, TRACKED, AT))
    versions = tables.write("customer_versions", timeline(events, KEY, TRACKED, AT))
    placed = orders.select("order_id", KEY, "order_date")
    found = as_of_carry(placed, versions, KEY, "order_date", how="left")
    tables.write("dated_orders", found.select(
        *placed.columns, *[F.col(v).alias(c) for c, v in POINTS.items()]))


def take_feed(feed: DataFrame, tables: VersionedTables, late: str = "apply") -> None:
    """Splice a feed of changes into the stored history. The same feed again changes nothing."""
    after = splice(tables.read("customer_events"), tables.read("customer_versions"),
                   labelled(feed), KEY, TRACKED, AT, late)
    orders = repoint(tables.read("dated_orders"), after.changed, KEY, "order_date", POINTS)
    tables.write("dated_orders", orders)
    tables.write("late_rejects", after.rejected)
    # The events come last: until they are stored, the feed can be taken again.
    tables.write("customer_versions", after.versions)
    tables.write("customer_events", after.events)
