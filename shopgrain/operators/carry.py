"""As-of join by carrying the last version forward, with no product of facts and versions.

Versions and facts of a key are put into one order of time, and each fact takes the last version
before it. A key with very many rows is cut into buckets of whole days: a running pass over the
days of such keys tells which version is in force when a bucket begins, so that buckets are worked
on apart, by different tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.session import materialise

BUCKET_ROWS = 1 << 16


def as_of_carry(
    facts: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str = "valid_from",
    valid_to: str = "valid_to", how: str = "inner", bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """`operators.joins.as_of_join` for versions of a key that do not overlap, in linear work.

    Each fact is given the columns of the version in force at `at`: the one that began last, if it
    has not ended. Facts without one, and those with a NULL key or time, are left out, or keep NULLs
    with how="left". Of versions that begin at the same instant one is taken. A day is never cut, so a bucket can be as large
    as the busiest day of one key.
    """
    own, held = F.struct(*facts.columns), F.struct(*[c for c in versions.columns if c != key])
    of_fact = facts.select(own.alias("r")).schema["r"].dataType
    of_version = versions.select(held.alias("r")).schema["r"].dataType
    starts = versions.select(
        F.col(key).alias("k"), F.col(valid_from).alias("t"), F.lit(None).cast(of_fact).alias("fact"),
        held.alias("version")).where("k IS NOT NULL AND t IS NOT NULL")
    events = starts.unionByName(facts.select(
        F.col(key).alias("k"), F.col(at).alias("t"), own.alias("fact"),
        F.lit(None).cast(of_version).alias("version")).where("k IS NOT NULL AND t IS NOT NULL"))
    events = events.withColumn("day", F.to_date("t"))

    # The days of keys beyond one bucket: how many rows lie up to each, and the version before it.
    # Both are written, as their size, most often none, decides whether all events are shuffled.
    large = materialise(events.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > bucket_rows).select("k"), "large")
    rows = events.join(large, "k", "left_semi").groupBy("k", "day").agg(F.count(F.lit(1)).alias("n"))
    last = starts.withColumn("day", F.to_date("t")).join(large, "k", "left_semi").groupBy(
        "k", "day").agg(F.max_by("version", "t").alias("last"))
    by_day = W.partitionBy("k").orderBy("day")
    days = rows.join(last, ["k", "day"], "left").select(
        "k", "day",
        F.floor((F.sum("n").over(by_day.rowsBetween(W.unboundedPreceding, 0)) - 1) / bucket_rows)
        .alias("bucket"),
        F.last("last", ignorenulls=True).over(by_day.rowsBetween(W.unboundedPreceding, -1))
        .alias("carried"))
    first_day = W.partitionBy("k", "bucket").orderBy("day")
    days = materialise(days.withColumn("carried", F.first("carried").over(first_day)), "days")

    dealt = events.join(days, ["k", "day"], "left").withColumn(
        "bucket", F.coalesce("bucket", F.lit(0)))
    # A version that begins at the instant of a fact is in force: versions come first.
    order = W.partitionBy("k", "bucket").orderBy("t", F.col("fact").isNotNull())
    now = F.last("version", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    found = dealt.withColumn("now", F.coalesce(now, "carried")).where("fact IS NOT NULL")
    in_force = F.col(f"now.`{valid_to}`").isNull() | (F.col("t") < F.col(f"now.`{valid_to}`"))
    valid = F.col("now").isNotNull() & in_force
    if how == "inner":
        return found.where(valid).select("fact.*", "now.*")
    rest = facts.where(F.col(key).isNull() | F.col(at).isNull())
    return found.withColumn("now", F.when(valid, F.col("now"))).select(
        "fact.*", "now.*").unionByName(rest, allowMissingColumns=True)
