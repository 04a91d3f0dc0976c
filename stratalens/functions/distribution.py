"""Expressions over one group's level counts.

A group is an ``ARRAY<DOUBLE>`` in scale order.  Every expression is unrolled
over the (static) number of levels, so that Spark compiles it into the same
generated stage as its neighbours; higher-order functions would leave it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOMENTS = ("ordinal_mean", "ordinal_sd", "ordinal_skew", "ordinal_kurt", "bimodality_coef")


def plus(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


def levels(counts: Column | str, size: int) -> list[Column]:
    """The single levels of an array column, NULL where the array is shorter."""
    column = F.col(counts) if isinstance(counts, str) else counts
    return [F.get(column, F.lit(i)) for i in range(size)]


def level_sum(columns: Sequence[Column]) -> Column:
    """Sum that skips missing values; zero when all are missing."""
    return plus([F.coalesce(c, F.lit(0.0)) for c in columns])


def has_negative(columns: Sequence[Column]) -> Column:
    """Whether a reported level is negative, which makes the whole group unusable."""
    return reduce(lambda a, b: a | b, [F.coalesce(c < 0, F.lit(False)) for c in columns])


def filled(counts: Column | str, size: int) -> Column:
    """The counts with zero for every missing level."""
    return F.array(*[F.coalesce(c, F.lit(0.0)) for c in levels(counts, size)])


def is_complete(columns: Sequence[Column], mode: str) -> Column:
    """Whether a group has data.

    ``any``           at least one level is reported
    ``all``           every level is reported, none is negative
    ``positive_sum``  the reported levels add up to more than zero
    """
    if mode == "any":
        return reduce(lambda a, b: a | b, [c.isNotNull() for c in columns])
    if mode == "all":
        ok = reduce(lambda a, b: a & b, [F.coalesce(c >= 0, F.lit(False)) for c in columns])
        return ok & (level_sum(columns) > 0)
    if mode == "positive_sum":
        return level_sum(columns) > 0
    raise ValueError(f"unknown completeness mode {mode!r}")


def percentages(counts: Column | str, size: int, null_as_zero: bool = False) -> Column:
    """Counts to percentages of the group's own sum; NULL when that is not positive.

    A missing level stays missing unless ``null_as_zero``.  A negative count
    makes the whole group missing.
    """
    parts = levels(counts, size)
    if null_as_zero:
        parts = [F.coalesce(c, F.lit(0.0)) for c in parts]
    total = level_sum(parts)
    usable = (total > 0) & ~has_negative(parts)
    return F.array(*[F.when(usable, c / total * 100) for c in parts])


def collapse(counts: Column | str, mapping: Sequence[int]) -> Column:
    """Merge levels: level ``i`` is added to target level ``mapping[i]``; missing counts as zero."""
    parts = levels(counts, len(mapping))
    return F.array(*[
        level_sum([parts[i] for i, goal in enumerate(mapping) if goal == target])
        for target in range(max(mapping) + 1)
    ])


def mean_level(shares: Sequence[Column]) -> Column:
    """Ordinal mean of a percentage distribution; missing if any level is."""
    return plus([p * float(i) for i, p in enumerate(shares, start=1)]) / 100


def with_moments(df: DataFrame, size: int, shares: str = "shares", zero_sd: str = "keep") -> DataFrame:
    """Add mean, population sd, skewness, excess kurtosis and bimodality of each group.

    Needs every level of the group.  With all mass on one level the last three
    have no value; ``zero_sd="null_all"`` then drops the first two as well.
    """
    if zero_sd not in ("keep", "null_all"):
        raise ValueError(f"unknown zero_sd policy {zero_sd!r}")
    p = levels(shares, size)
    mean, sd = F.col("ordinal_mean"), F.col("ordinal_sd")

    def central(power: int) -> Column:
        terms = []
        for i, share in enumerate(p, start=1):
            gap = float(i) - mean
            terms.append(share * reduce(lambda a, b: a * b, [gap] * power))
        return plus(terms) / 100

    out = df.withColumn("ordinal_mean", mean_level(p))
    out = out.withColumns({
        "ordinal_sd": F.sqrt(central(2)),
        "_m3": central(3),
        "_m4": central(4),
    })
    spread = sd > 0
    out = out.withColumns({
        "ordinal_skew": F.when(spread, F.col("_m3") / (sd * sd * sd)),
        "_kurt": F.when(spread, F.col("_m4") / (sd * sd * sd * sd)),
    })
    out = out.withColumns({
        "ordinal_kurt": F.col("_kurt") - 3.0,
        "bimodality_coef": (F.col("ordinal_skew") * F.col("ordinal_skew") + 1.0) / F.col("_kurt"),
    })
    if zero_sd == "null_all":
        out = out.withColumns({
            "ordinal_mean": F.when(spread, mean),
            "ordinal_sd": F.when(spread, sd),
        })
    return out.drop("_m3", "_m4", "_kurt")


def earth_mover(start: Sequence[Column], end: Sequence[Column]) -> Column:
    """Wasserstein-1 distance of two percentage distributions on unit-spaced levels."""
    steps, gap = [], F.lit(0.0)
    for a, b in list(zip(start, end, strict=True))[:-1]:
        gap = gap + (a - b)
        steps.append(F.abs(gap))
    complete = start[-1].isNotNull() & end[-1].isNotNull()
    return F.when(complete, plus(steps) / 100)


def count_stable(start: Column, end: Column, threshold: float = 0.25) -> Column:
    """Whether a count changed by at most ``threshold`` of its start; unknown is not stable."""
    change = F.try_divide(F.abs(end - start), start)
    return F.coalesce(change <= threshold, F.lit(False))


def first_positive(columns: Sequence[Column]) -> Column:
    """The first positive value; the last one if none is."""
    result = columns[-1]
    for column in reversed(columns[:-1]):
        result = F.when(column > 0, column).otherwise(result)
    return result
