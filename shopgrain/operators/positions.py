"""Rows at given positions of a total order, found without sorting everything in one task.

A global window (`ntile`, `row_number`, or a median over all rows) sends every row to one task.
Here a first pass takes a mergeable quantile sketch of the leading columns, which brackets every
position between two values. A second pass counts the rows of each bracket by value, or by steps of
values where it is large, and the rows between brackets; that decides the positions exactly,
whatever the sketch was. What is still open (steps of several values, ties on the leading column) is
counted again in the same way within its range. Any number of positions of any number of orders
take part in the same passes, and the driver sees bounded counts. NULL sorts before every value, as
in Spark's own ascending order.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 1 << 16  # counts that the driver is sent per round and order
GRID = 2048  # quantiles that the sketch is asked for,
ACCURACY = 10_000  # each off by at most this part of the rows
NULL_STEP = -1


@dataclass
class _Range:
    """Positions still looked for among rows with the given first values, and a range of the next."""

    order: int
    prefix: tuple
    low: int
    high: int
    nulls: bool                # NULLs of the next column belong to it too
    wanted: dict[int, int]     # position asked for -> position within the range

    def width(self, fanout: int) -> int:
        return (self.high - self.low) // fanout + 1

    def step(self, columns: list[str], fanout: int) -> Column:
        """The step a row falls in, NULL for rows outside."""
        c = F.col(columns[len(self.prefix)])
        wide = c.cast("decimal(20,0)") if self.high - self.low >= 1 << 62 else c
        number = F.when(c.between(self.low, self.high), F.floor(
            (wide - F.lit(self.low)) / F.lit(self.width(fanout))).cast("bigint")
            if wide is not c else F.expr(
                f"(`{columns[len(self.prefix)]}` - ({self.low}L)) div {self.width(fanout)}L"))
        if self.nulls:
            number = F.when(c.isNull(), F.lit(NULL_STEP).cast("bigint")).otherwise(number)
        inside = F.lit(True)
        for name, value in zip(columns, self.prefix):
            inside = inside & F.col(name).eqNullSafe(F.lit(value))
        return F.when(inside, number)


def rows_at_each(
    df: DataFrame, orders: list[list[str]], positions: Callable[[int], list[int]],
    fanout: int = FANOUT,
) -> list[dict[int, tuple]]:
    """For each order, the order values at 1-based positions, sorting ascending by its BIGINT columns.

    `positions` is given the row count and names the positions wanted. Rows that tie on all columns
    of an order are interchangeable, so the answer is always exact.
    """
    columns = list(dict.fromkeys(c for order in orders for c in order))
    leading = list(dict.fromkeys(order[0] for order in orders))
    grid = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    ends = df.agg(F.count(F.lit(1)).alias("_n"), *[
        f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(columns) for f in (F.min, F.max, F.count)
    ], *[F.percentile_approx(c, grid, ACCURACY).alias(f"grid_{columns.index(c)}") for c in leading],
    ).first()
    size, wanted = ends["_n"], positions(ends["_n"])
    found: list[dict[int, tuple]] = [{} for _ in orders]
    if not wanted:
        return found
    if max(wanted) > size or min(wanted) < 1:
        raise ValueError(f"positions {wanted} outside 1..{size}")

    def whole(order: int, prefix: tuple, local: dict[int, int]) -> Iterator[_Range]:
        """The whole range of the next column, or none where every column has its value."""
        if len(prefix) == len(orders[order]):
            found[order].update({p: prefix for p in local})
            return
        i = columns.index(orders[order][len(prefix)])
        low, high = ends[f"min_{i}"], ends[f"max_{i}"]
        yield _Range(order, prefix, low or 0, high or 0, True, local)

    def inside(order: int, prefix: tuple, low: int, high: int, local: dict[int, int]) -> Iterator[_Range]:
        """What is left to look at of the values low to high."""
        if low == high:
            yield from whole(order, (*prefix, low), local)
        else:
            yield _Range(order, prefix, low, high, False, local)

    open_ranges: list[_Range] = []
    cells = [_cells(ends, columns.index(o[0]), wanted, fanout) for o in orders]
    marks = [F.struct(F.lit(k).alias("i"), _cell_of(o[0], c).alias("at"))
             for k, (o, c) in enumerate(zip(orders, cells, strict=True))]
    counted = df.select(F.explode(F.array(*marks)).alias("x")).groupBy(
        "x.i", "x.at.low", "x.at.high").count().collect()
    for k in range(len(orders)):
        before = 0
        mine = sorted((row for row in counted if row["i"] == k),
                      key=lambda row: (row["low"] is not None, row["low"]))
        for row in mine:
            local = {p: p - before for p in wanted if before < p <= before + row["count"]}
            before += row["count"]
            if local and row["low"] is None:
                open_ranges += whole(k, (None,), local)
            elif local:
                open_ranges += inside(k, (), row["low"], row["high"], local)

    while open_ranges:
        share = max(2, fanout // len(open_ranges))
        steps = [F.struct(F.lit(i).alias("i"), r.step(orders[r.order], share).alias("step"))
                 for i, r in enumerate(open_ranges)]
        hits = df.select(F.explode(F.filter(
            F.array(*steps), lambda x: x["step"].isNotNull())).alias("x"))
        counts = defaultdict(dict)
        for row in hits.groupBy("x.i", "x.step").count().collect():
            counts[row["i"]][row["step"]] = row["count"]
        following: list[_Range] = []
        for i, r in enumerate(open_ranges):
            before = 0
            for step, n in sorted(counts[i].items()):
                local = {p: at - before for p, at in r.wanted.items() if before < at <= before + n}
                before += n
                if not local:
                    continue
                low = r.low + step * r.width(share)
                if step == NULL_STEP:
                    following += whole(r.order, (*r.prefix, None), local)
                else:
                    following += inside(r.order, r.prefix, low,
                                        min(low + r.width(share) - 1, r.high), local)
        open_ranges = following
    return found


def _cells(ends, column: int, wanted: list[int], fanout: int) -> list[tuple[int, int, int]]:
    """low, high, width: the range of a leading column, parted into brackets of positions and gaps.

    Values of a cell are counted in steps of its width; a gap is one step.
    """
    low, high, grid = ends[f"min_{column}"], ends[f"max_{column}"], ends[f"grid_{column}"]
    present = ends[f"count_{column}"]
    if low is None:
        return []
    brackets: list[list[int]] = []
    for p in sorted(wanted):
        share = (p - (ends["_n"] - present)) / present  # NULLs come first
        first = math.floor((share - 1 / ACCURACY) * GRID)
        last = math.ceil((share + 1 / ACCURACY) * GRID)
        if last < 0:
            continue
        a, b = grid[first] if first > 0 else low, grid[last] if last < GRID else high
        if brackets and a <= brackets[-1][1] + 1:
            brackets[-1][1] = max(brackets[-1][1], b)
        else:
            brackets.append([a, b])
    out, at = [], low
    # As many rows as the brackets have can be counted by value; else by steps.
    few = len(brackets) and present * 2.0 * len(wanted) / GRID <= fanout
    for a, b in brackets:
        if a > at:
            out.append((at, a - 1, a - at))
        out.append((a, b, 1 if few else (b - a) // max(1, fanout // len(brackets)) + 1))
        at = b + 1
    return out + [(at, high, high - at + 1)] if at <= high else out


def _cell_of(name: str, cells: list[tuple[int, int, int]]) -> Column:
    """low and high of the step that a value lies in; NULL for NULL."""
    c, none = F.col(name), F.lit(None).cast("bigint")
    out = F.struct(none.alias("low"), none.alias("high"))
    for low, high, width in cells:
        if width == 1:
            span = F.struct(c.alias("low"), c.alias("high"))
        elif width > high - low:
            span = F.struct(F.lit(low).cast("bigint").alias("low"), F.lit(high).cast("bigint").alias("high"))
        else:
            start = F.expr(f"`{name}` - pmod(`{name}` - ({low}L), {width}L)")
            span = F.struct(start.alias("low"), F.least(
                start + (width - 1), F.lit(high).cast("bigint")).alias("high"))
        out = F.when(c.between(low, high), span).otherwise(out)
    return out


def rows_at(
    df: DataFrame, order: list[str], positions: Callable[[int], list[int]], fanout: int = FANOUT,
) -> dict[int, tuple]:
    """`rows_at_each` for one order."""
    return rows_at_each(df, [order], positions, fanout)[0]


def exact_median(df: DataFrame, column: str) -> float | None:
    """Median of a BIGINT column, NULLs left out, interpolated between the two middle rows."""
    def middle(size: int) -> list[int]:
        return sorted({(size + 1) // 2, size // 2 + 1}) if size else []

    present = df.where(F.col(column).isNotNull())
    values = [row[0] for row in rows_at(present, [column], middle).values()]
    return sum(values) / len(values) if values else None


def is_after(order: list[str], cut: tuple) -> Column:
    """True where a row sorts after `cut`, NULL before every value."""
    after = F.lit(False)
    for name, value in reversed(list(zip(order, cut))):
        c = F.col(name)
        if value is None:
            after = c.isNotNull() | after
        else:
            after = F.coalesce(c > F.lit(value), F.lit(False)) | (c.eqNullSafe(F.lit(value)) & after)
    return after


def global_ntiles(
    df: DataFrame, orders: list[list[str]], tiles: int, fanout: int = FANOUT,
) -> list[Column]:
    """For each order a column equal to `ntile(tiles) over (order by ...)`, for total orders.

    df is read once per round of counting for all orders together, so it should be a written table.
    A returned column compares a row with `tiles - 1` constants and needs no shuffle.
    """
    def tile_ends(size: int) -> list[int]:
        share, extra = divmod(size, tiles)
        ends = {j * share + min(j, extra) for j in range(1, tiles)}
        return sorted(p for p in ends if 0 < p < size)

    out = []
    for order, cuts in zip(orders, rows_at_each(df, orders, tile_ends, fanout)):
        tile = F.lit(1)
        for cut in cuts.values():
            tile = tile + F.when(is_after(order, cut), 1).otherwise(0)
        out.append(tile)
    return out


def global_ntile(df: DataFrame, order: list[str], tiles: int, fanout: int = FANOUT) -> Column:
    """`global_ntiles` for one order."""
    return global_ntiles(df, [order], tiles, fanout)[0]
