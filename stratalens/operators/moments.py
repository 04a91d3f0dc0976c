"""Moments, scores and shares per entity and timepoint.

Each function is narrow work per group followed by one aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import MOMENTS, levels, mean_level, percentages, plus, with_moments
from ..scales import Group
from .counts import same_group


def with_shares(df: DataFrame, size: int, null_as_zero: bool = False) -> DataFrame:
    """Add the percentage distribution of each group."""
    return df.withColumn("shares", percentages("counts", size, null_as_zero))


def group_moments(df: DataFrame, size: int, null_as_zero: bool = False, zero_sd: str = "keep") -> DataFrame:
    """Long counts with shares and moments per group.  No shuffle."""
    return with_moments(with_shares(df, size, null_as_zero), size, zero_sd=zero_sd)


def entity_moments(df: DataFrame, keys: Sequence[str], size: int, null_as_zero=False, zero_sd="keep") -> DataFrame:
    """Moments per entity and timepoint: the mean over its groups that have a value."""
    groups = group_moments(df, size, null_as_zero, zero_sd)
    return groups.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in MOMENTS])


def ordinal_score(df: DataFrame, keys: Sequence[str], size: int, null_as_zero: bool = False) -> DataFrame:
    """Only the ordinal mean, for callers that need no other moment."""
    shares = with_shares(df, size, null_as_zero)
    return shares.groupBy(*keys).agg(F.avg(mean_level(levels("shares", size))).alias("ordinal_score"))


def group_has_data(size: int, shares: str = "shares") -> Column:
    """Whether a group has a full distribution."""
    present = levels(shares, size)
    out = present[0].isNotNull()
    for p in present[1:]:
        out = out & p.isNotNull()
    return out


def group_score_columns(groups: Sequence[Group]) -> list[Column]:
    """Aggregates: one ordinal mean per group, named after the group."""
    return [F.avg(F.when(same_group(g), F.col("ordinal_mean"))).alias(f"ordinal_{g.key}") for g in groups]


def grade_score_columns(groups: Sequence[Group]) -> list[Column]:
    """Aggregates: one ordinal mean per grade, over its languages."""
    grades = dict.fromkeys(g.grade for g in groups)
    return [F.avg(F.when(F.col("grade") == grade, F.col("ordinal_mean"))).alias(f"ordinal_{grade}") for grade in grades]


def top_share(size: int) -> Column:
    """Aggregate: mean percentage on the best level over groups with a full distribution."""
    return F.avg(F.when(group_has_data(size), levels("shares", size)[-1]))


def share_of_levels(chosen: Sequence[int], size: int) -> Column:
    """Percentage of a group on the given levels (0-based)."""
    parts = levels("shares", size)
    return plus([parts[i] for i in chosen])


def weighted_parts(weights: Sequence[float]) -> tuple[Column, Column]:
    """Weighted percentage and weight of one group, over the levels that are present."""
    pairs = list(zip(levels("shares", len(weights)), [float(w) for w in weights], strict=True))
    weighted = plus([F.coalesce(p * w, F.lit(0.0)) for p, w in pairs])
    weight = plus([F.when(p.isNotNull(), F.lit(w)).otherwise(0.0) for p, w in pairs])
    return weighted, weight


def performance_score(df: DataFrame, keys: Sequence[str], weights: Sequence[float], null_as_zero=False) -> DataFrame:
    """Weighted mean percentage over the levels that are present; NULL when no weight applies."""
    weighted, weight = weighted_parts(weights)
    sums = with_shares(df, len(weights), null_as_zero).groupBy(*keys).agg(
        F.sum(weighted).alias("_weighted"), F.sum(weight).alias("_weight")
    )
    return sums.select(*keys, F.try_divide("_weighted", "_weight").alias("performance"))


def level_averages(
    df: DataFrame, keys: Sequence[str], names: Sequence[str], weights: Mapping[str, float], null_as_zero=False
) -> DataFrame:
    """Mean percentage of each level over the groups, and the same times its weight over 100."""
    parts = levels("shares", len(names))
    means = [F.avg(p).alias(f"avg_{name}") for name, p in zip(names, parts, strict=True)]
    out = with_shares(df, len(names), null_as_zero).groupBy(*keys).agg(*means)
    return out.withColumns({
        f"weighted_{name}": F.col(f"avg_{name}") * (weights[name] / 100.0) for name in names if name in weights
    })
