"""Joins with special semantics: as-of, three-valued NOT IN, and a join that is only counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_join(
    facts: DataFrame, versions: DataFrame, key: str, at: str,
    valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "inner",
) -> DataFrame:
    """Each fact with the version whose half-open interval [valid_from, valid_to) holds `at`.

    An equi join on key with the interval as residual condition, so it hashes on key and AQE can
    split a hot key. An open interval has a NULL end.
    """
    v = versions.withColumnRenamed(key, "_version_key")
    matches = (
        (F.col(key) == F.col("_version_key"))
        & (F.col(at) >= F.col(valid_from))
        & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to)))
    )
    return facts.join(v, matches, how).drop("_version_key")


def not_exists(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None):
    """Rows of left without a match; NULL keys never match, so they stay."""
    keys = right.select(F.col(right_key or key).alias(key)).distinct()
    return left.join(keys, key, "left_anti")


def not_in(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """`key NOT IN (SELECT right_key FROM right)` with SQL's three-valued logic.

    One NULL on the right empties the result; a NULL on the left passes only if right is empty.
    Spark's own plan for NOT IN broadcasts the right side whatever its size. This one shuffles
    distinct keys and adds the NULL rules as scalar subqueries.
    """
    keys = right.select(F.col(right_key or key).alias(key))
    nulls = keys.agg(F.count_if(F.col(key).isNull()))
    empty = keys.limit(1).agg(F.count(F.lit(1)) == 0)
    return not_exists(left, keys, key).where(
        (nulls.scalar() == 0) & (F.col(key).isNotNull() | empty.scalar())
    )


def join_size(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """What an inner join on `on` would do to the row count, without doing the join.

    Rows are counted per key on each side first, so a key that multiplies badly costs one row.
    `top_key` is the key with the most joined rows, the smallest of those that tie.
    """
    l = left.groupBy(*on).agg(F.count(F.lit(1)).alias("l"))
    r = right.groupBy(*on).agg(F.count(F.lit(1)).alias("r"))
    both = l.join(r, on, "left")
    pairs = F.col("l") * F.coalesce(F.col("r"), F.lit(0))
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in on])
    return both.agg(
        F.sum("l").alias("rows_before"),
        F.sum(pairs).alias("rows_after"),
        F.max("r").alias("max_matches_per_key"),
        F.sum(F.when(F.col("r").isNull(), F.col("l")).otherwise(0)).alias("rows_unmatched"),
        F.min(F.struct((-pairs).alias("pairs"), name.alias("name"))).getField("name")
        .alias("top_key"),
    )


def label_null(c: Column, label: str) -> Column:
    return F.coalesce(c, F.lit(label))
