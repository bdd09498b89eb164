"""Rows dealt to disjoint ranges of a day and a number, by bounds that a narrow table of keys gives.

`repartitionByRange` draws its bounds from the rows it cuts, so whatever stands between them and the
last shuffle, a join or a merge, runs twice. Here only the keys are read twice. Bounds decide which
file a row goes to and nothing else.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_ROWS = 1 << 17  # rows of a range
LEAST_ROWS = 1 << 14  # rows below which no range is made to keep a core busy
LOWEST = -(1 << 63)


def range_count(spark: SparkSession, rows: int) -> int:
    """Ranges for so many rows; as many as a shuffle has partitions, where these are not merged."""
    wanted = max(-(-rows // RANGE_ROWS), min(spark.sparkContext.defaultParallelism, rows // LEAST_ROWS), 1)
    if spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true":
        return wanted
    return max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_starts(keys: DataFrame, day: str, at: str, n: int) -> list[tuple[int, int]]:
    """The first (day, at) of each of n ranges or fewer that hold about as many keys each."""
    known = keys.select(day, at).where(F.col(day).isNotNull() & F.col(at).isNotNull())
    dealt = known.repartitionByRange(n, day, at).select(
        F.spark_partition_id().alias("part"), F.struct(day, at).alias("key"))
    firsts = dealt.groupBy("part").agg(F.min("key").alias("first")).select("first.*").collect()
    return sorted((r[day], r[at]) for r in firsts)


def day_ranges(starts: list[tuple[int, int]], days: list[int]) -> list[tuple]:
    """day, low, high, part: which range the numbers of a day from low on, below high, belong to."""
    out = []
    for day in sorted({*days, *(d for d, _ in starts)}):
        low, high = bisect_left(starts, (day, LOWEST)), bisect_right(starts, (day, -LOWEST))
        edges = [LOWEST, *(at for _, at in starts[low:high]), None]
        out += [(day, first, end, max(low - 1 + k, 0))
                for k, (first, end) in enumerate(zip(edges, edges[1:]))]
    return out


def cut_by_range(
    df: DataFrame, starts: list[tuple[int, int]], days: list[int], day: str, at: str, n: int,
    derived: dict[str, Column] | None = None,
) -> DataFrame:
    """df in n partitions by ranges, each sorted by (day, at).

    `derived` tells columns by the others of their row: they are not shuffled but made afterwards.
    `days` are the values of day that occur; a row of any other one goes to the first range, as does
    one without a day. Many ranges of one day are gone through for each of its rows.
    """
    spark, made = df.sparkSession, derived or {}
    kinds = pa.schema({"_day": pa.int64(), "_low": pa.int64(), "_high": pa.int64(), "_part": pa.int32()})
    ranges = spark.createDataFrame(pa.Table.from_pylist(
        [dict(zip(kinds.names, r, strict=True)) for r in day_ranges(starts, days)], kinds))
    number = F.coalesce(F.col(at), F.lit(LOWEST))
    inside = ((F.col(day) == F.col("_day")) & (number >= F.col("_low"))
              & (F.col("_high").isNull() | (number < F.col("_high"))))
    carried = [c for c in df.columns if c not in made]
    placed = df.select(*carried).join(ranges, inside, "left").select(
        *carried, F.coalesce("_part", F.lit(0)).alias("_part"))
    return placed.repartitionById(n, "_part").sortWithinPartitions(day, at).select(
        *[made[c].alias(c) if c in made else c for c in df.columns])
