"""Number helpers.

Sums stay DECIMAL (exact, so independent of task order); a ratio or mean turns the finished sums
into DOUBLE, and rounding is the very last step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(x: Column, places: int) -> Column:
    """Round half away from zero, the same in every engine that has IEEE doubles."""
    d = x.cast("double")
    scale = float(10**places)
    return F.signum(d) * F.floor(F.abs(d) * scale + 0.5) / scale + F.lit(0.0)


def round2(x: Column) -> Column:
    return round_to(x, 2)


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE; NULL when den is 0 (ANSI mode would raise)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column) -> Column:
    """num as a percentage of den, rounded to two places."""
    return round2(num.cast("double") * 100.0 / F.nullif(den.cast("double"), F.lit(0.0)))


def mean(x: Column) -> Column:
    """Average as exact sum over count; `avg` on decimals would round to six places midway."""
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))


def cents(x: Column) -> Column:
    """A two-place decimal as a whole number of cents."""
    return (x * 100).cast("bigint")
