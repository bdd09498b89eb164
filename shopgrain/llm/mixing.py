"""Mixing sources to target weights by iterative proportional fitting, by DataFrame functions only.

Tokens are summed per cell, a combination of the values of all dimensions. Raking then scales the
cells to each dimension's target marginal in turn, for a fixed number of rounds, so that all
marginals approach their targets together; only cells take part, never rows. A document's inclusion
probability is its cell's scaled weight over its weight, relative to the largest such ratio, so
that the expected sample has the raked mix and no document is needed twice. A hash of the document
id against that probability decides, the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.session import materialise

# Kinds of text by their look, the topic of a corpus that brings no topics.
TOPICS = ("table", "markup", "shout", "short", "prose")


def topic(text: Column) -> Column:
    body = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(body, F.lit(" | ")), "table")
            .when(body.rlike(r"[#*$%&]{3}"), "markup")
            .when(F.contains(body, F.lit("!!")), "shout")
            .when(F.char_length(body) < 500, "short").otherwise("prose"))


def tokens(text: Column) -> Column:
    """Words between ASCII white space."""
    body = F.coalesce(text, F.lit(""))
    return F.size(F.filter(F.split(body, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("bigint")


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """dimension, target: its shares raised to a power below 1, which lifts the rare values."""
    sums = cells.groupBy(dimension).agg(F.sum("weight").alias("w"))
    total = sums.agg(F.sum(F.pow("w", F.lit(power)))).first()[0]
    return sums.select(dimension, (F.pow("w", F.lit(power)) / F.lit(total or 1.0)).alias("target"))


def rake(cells: DataFrame, dimensions: list[str], targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    """cells with fitted: weights whose marginals approach the targets.

    A target lists a dimension's values and shares; a value without a target keeps none, and targets
    of values that no cell has are ignored. NULL is a value like any other.
    """
    total = F.lit(cells.agg(F.sum("weight")).first()[0] or 0).cast("double")
    fitted = cells.withColumn("fitted", F.col("weight").cast("double"))
    for d in dimensions:
        wanted = targets[d].select(F.col(d).alias("_value"), F.col("target").alias(f"_target_{d}"))
        fitted = fitted.join(wanted, F.col(d).eqNullSafe(F.col("_value")), "left").drop("_value")
    fitted = materialise(fitted.na.fill(0.0, [f"_target_{d}" for d in dimensions]), "cells")
    for _ in range(rounds):
        for d in dimensions:
            now = F.sum("fitted").over(Window.partitionBy(d))
            fitted = fitted.withColumn("fitted", F.when(
                now > 0, F.col("fitted") * F.col(f"_target_{d}") * total / now
            ).otherwise(0.0))
    return fitted.drop(*[f"_target_{d}" for d in dimensions])


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 48 bits of an MD5; NULL counts as the empty text."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def inclusion(
    docs: DataFrame, dimensions: list[str], weight: str = "n_words", power: float = 0.7,
    targets: dict[str, DataFrame] | None = None, rounds: int = 6,
) -> DataFrame:
    """docs with inclusion, the probability at which each row belongs in the mix.

    `targets` gives shares by dimension; without them a dimension's own shares are tempered by
    `power`. Rows of weight 0 (NULL and empty texts) count in no marginal and are included like
    their cell; a cell without any weight has probability 0. An empty table stays empty.
    """
    docs = docs.drop("inclusion")
    cells = materialise(docs.groupBy(*dimensions).agg(F.sum(weight).alias("weight")), "weights")
    wanted = targets or {d: tempered(cells.where("weight > 0"), d, power) for d in dimensions}
    fitted = materialise(rake(cells.where("weight > 0"), dimensions, wanted, rounds), "raked")
    ratio = F.col("fitted") / F.col("weight")
    top = fitted.agg(F.max(ratio)).first()[0] or 1.0
    rates = fitted.select(*[F.col(d).alias(f"_cell_{d}") for d in dimensions],
                          (ratio / F.lit(top)).alias("inclusion"))
    same = [F.col(d).eqNullSafe(F.col(f"_cell_{d}")) for d in dimensions]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return docs.join(rates, on, "left").drop(*[f"_cell_{d}" for d in dimensions]).na.fill(
        0.0, ["inclusion"])


def sample(
    docs: DataFrame, dimensions: list[str], key: str = "doc_id", seed: str = "mix", **options,
) -> DataFrame:
    """The rows of docs that are drawn, with their inclusion; rows of one id are drawn together."""
    return inclusion(docs, dimensions, **options).where(draw(F.col(key), seed) < F.col("inclusion"))
