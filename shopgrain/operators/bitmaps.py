"""Months of activity as bits, kept as a state that takes deltas in any order.

A user has a row per 60 months with a bit for each month of activity. States are OR-ed, so a delta
may repeat what is known, and the same orders in any split give the same state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTHS = 60  # bits of a word


def activity(rows: DataFrame, user: str, month_no: Column) -> DataFrame:
    """user_id, word, bits of rows; month_no counts months from any origin and is not negative."""
    return rows.select(F.col(user).alias("user_id"), month_no.alias("m")).where(
        "user_id IS NOT NULL AND m IS NOT NULL").groupBy(
        "user_id", F.expr(f"CAST(m div {MONTHS} AS INT)").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST(m % {MONTHS} AS INT)))").alias("bits"))


def merge(state: DataFrame, delta: DataFrame) -> DataFrame:
    return state.unionByName(delta).groupBy("user_id", "word").agg(F.expr("bit_or(bits)").alias("bits"))


def months(state: DataFrame) -> DataFrame:
    """user_id, month_no of all set bits."""
    place = F.explode(F.filter(F.sequence(F.lit(0), F.lit(MONTHS - 1)),
                               lambda k: F.getbit("bits", k) == 1))
    return state.select("user_id", "word", place.alias("place")).select(
        "user_id", (F.col("word") * MONTHS + F.col("place")).alias("month_no"))


def retention_counts(state: DataFrame) -> DataFrame:
    """cohort (a user's first month), month_offset, active_users."""
    lowest = F.expr("bit_count((bits & -bits) - 1)")  # zeros below the first set bit
    first = state.groupBy("user_id").agg(F.min(F.col("word") * MONTHS + lowest).alias("cohort"))
    return months(state).join(first, "user_id").groupBy(
        "cohort", (F.col("month_no") - F.col("cohort")).alias("month_offset")).agg(
        F.count(F.lit(1)).alias("active_users"))
