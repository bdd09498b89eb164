"""Histories built from change events, which may come late, several at once, and in any order.

The events are kept; the versions of a key follow from its events alone. A feed is spliced in by
rebuilding the keys it touches, so any order and any cut of the same events gives the same versions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.operators.merge import row_diff
from shopgrain.session import materialise


def distinct_events(events: DataFrame, key: str, attributes: list[str], at: str) -> DataFrame:
    """One event per key and instant: of several the one with the greatest attributes counts."""
    newest = F.max(F.struct(*attributes)).alias("a")
    return events.groupBy(key, at).agg(newest).select(key, "a.*", at)


def timeline(events: DataFrame, key: str, attributes: list[str], at: str) -> DataFrame:
    """Versions with valid_from, valid_to (open: NULL) and is_current from one event per instant.

    An event whose attributes equal those before it opens no version.
    """
    by_time = W.partitionBy(key).orderBy(at)
    state = F.struct(*attributes)
    before = F.lag(state).over(by_time)
    opens = events.withColumn("_before", before).where(
        F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)).drop("_before")
    end = F.lead(at).over(by_time)
    return opens.select(key, *attributes, F.col(at).alias("valid_from"), end.alias("valid_to")) \
        .withColumn("is_current", F.col("valid_to").isNull())


@dataclass
class Splice:
    events: DataFrame    # all events that count
    versions: DataFrame  # the next state of the history
    changed: DataFrame   # versions that the feed has added or altered
    rejected: DataFrame  # late events that were turned away


def splice(
    held: DataFrame, versions: DataFrame, feed: DataFrame, key: str, attributes: list[str], at: str,
    late: str = "apply",
) -> Splice:
    """The history after a feed: held events and their versions, and the events that come in.

    `late="reject"` turns away events that do not lie after all held events of their key; then the
    cut into feeds matters, and rejected events say so. Keys the feed does not touch are passed
    through without a shuffle of their events. What several of the results take up is written once.
    """
    if late not in ("apply", "reject"):
        raise ValueError(f"late is apply or reject, not {late}")
    columns = [key, *attributes, at]
    feed = feed.select(*columns)
    if late == "reject":
        newest = held.groupBy(key).agg(F.max(at).alias("_newest"))
        seen = feed.join(newest, key, "left")
        is_late = F.coalesce(F.col(at) <= F.col("_newest"), F.lit(False))
        rejected, taken = (seen.where(c).select(*columns) for c in (is_late, ~is_late))
    else:
        rejected, taken = feed.limit(0), feed
    touched = materialise(taken.select(key).distinct(), "touched")
    mine = held.join(touched, key, "left_semi")
    merged = materialise(distinct_events(
        mine.select(*columns).unionByName(taken), key, attributes, at), "merged")
    rebuilt = materialise(timeline(merged, key, attributes, at), "rebuilt")
    old = versions.join(touched, key, "left_semi")
    changed = row_diff(old.select(*rebuilt.columns), rebuilt).where("change > 0").drop("change")
    return Splice(
        events=held.join(touched, key, "left_anti").select(*columns).unionByName(merged),
        versions=versions.join(touched, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt),
        changed=changed, rejected=rejected)


def repoint(
    facts: DataFrame, changed: DataFrame, key: str, at: str, columns: dict[str, str],
) -> DataFrame:
    """facts with `columns` (fact column: version column) taken anew from changed versions.

    Only facts that lie in a changed version are looked up; others keep what they have.
    """
    picked = changed.select(
        F.col(key).alias("_key"), "valid_from", "valid_to",
        F.struct(*columns.values()).alias("_version"))
    inside = ((F.col(key) == F.col("_key")) & (F.col(at) >= F.col("valid_from"))
              & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))))
    found = facts.join(picked, inside, "left")
    return found.select(*[
        F.when(F.col("_version").isNotNull(), F.col(f"_version.{columns[c]}")).otherwise(
            F.col(c)).alias(c) if c in columns else F.col(c) for c in facts.columns])
