"""Validity of an entity at a timepoint, and readable reasons for failing it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import filled, has_negative, is_complete, level_sum, levels
from ..scales import Group
from .counts import same_group

# The strict thresholds.
MIN_GROUPS = 4
MIN_ASSESSED = 15


def validity_aggregates(
    groups: Sequence[Group], size: int, mode: str = "any", null_as_zero: bool = False
) -> list[Column]:
    """Aggregates over the long counts of an entity and timepoint; ``finish_validity`` reads them."""
    parts = levels(filled("counts", size) if null_as_zero else F.col("counts"), size)
    total = level_sum(parts)
    has = is_complete(parts, mode) & (total > 0) & ~has_negative(parts)
    grades = dict.fromkeys(g.grade for g in groups)
    return [
        *[F.coalesce(F.bool_or(same_group(g) & has), F.lit(False)).alias(f"has_{g.key}") for g in groups],
        *[F.coalesce(F.bool_or((F.col("grade") == x) & has), F.lit(False)).alias(f"_grade_{x}") for x in grades],
        F.count_if(has).alias("groups_available"),
        F.min(F.when(has, total)).cast("bigint").alias("min_group_assessed"),
    ]


def finish_validity(
    df: DataFrame, groups: Sequence[Group], min_groups: int = MIN_GROUPS, min_assessed: int = MIN_ASSESSED
) -> DataFrame:
    """Add ``valid``, ``has_all_grades`` and ``valid_strict`` to the aggregates."""
    grades = dict.fromkeys(g.grade for g in groups)
    every = F.lit(True)
    for x in grades:
        every = every & F.col(f"_grade_{x}")
    out = df.withColumns({"valid": F.col("groups_available") > 0, "has_all_grades": every})
    strict = (
        F.col("valid")
        & F.col("has_all_grades")
        & (F.col("groups_available") >= min_groups)
        & F.coalesce(F.col("min_group_assessed") >= min_assessed, F.lit(False))
    )
    return out.withColumn("valid_strict", strict).drop(*[f"_grade_{x}" for x in grades])


def validity(
    df: DataFrame,
    keys: Sequence[str],
    groups: Sequence[Group],
    size: int,
    mode: str = "any",
    null_as_zero: bool = False,
    min_groups: int = MIN_GROUPS,
    min_assessed: int = MIN_ASSESSED,
) -> DataFrame:
    """Flags per entity and timepoint from long counts, in one aggregation.

    ``has_<group>`` and ``groups_available`` count groups with data (see
    ``is_complete``; a group that adds up to nothing has none), ``valid`` asks
    for one, ``valid_strict`` for every grade, ``min_groups`` groups and
    ``min_assessed`` learners in each reporting group.
    """
    counted = df.groupBy(*keys).agg(*validity_aggregates(groups, size, mode, null_as_zero))
    return finish_validity(counted, groups, min_groups, min_assessed)


def count_mismatch(start: Column, end: Column, threshold: float = 0.25, unknown: bool = True) -> Column:
    """Whether a count changed by more than ``threshold``.

    An unknown change counts as ``unknown``; pass ``False`` for tables that must
    equal older exports, where it was not flagged.
    """
    change = F.try_divide(F.abs(end - start), start)
    return F.coalesce(change > threshold, F.lit(unknown))


def plausible_reassessment(later: Column, earlier_pool: Column, allowance: float = 1.10) -> Column:
    """Whether a later count fits into the earlier pool, with an allowance."""
    return later <= earlier_pool * allowance


def failure_stage(min_groups: int = MIN_GROUPS, min_assessed: int = MIN_ASSESSED) -> Column:
    """First strict criterion that fails; every entity falls into exactly one stage."""
    return (
        F.when(~F.col("valid"), "no_data")
        .when(~F.col("has_all_grades"), "missing_grade")
        .when(F.col("groups_available") < min_groups, "few_groups")
        .when(F.coalesce(F.col("min_group_assessed") < min_assessed, F.lit(True)), "small_group")
        .otherwise("strict")
    )


def endpoint_tags(
    present: Column,
    valid: Column,
    has_all_grades: Column,
    groups_available: Column,
    min_group_assessed: Column,
    label: str,
    loaded: bool = True,
    min_groups: int = MIN_GROUPS,
    min_assessed: int = MIN_ASSESSED,
) -> list[Column]:
    """Failure tags of one endpoint, each NULL when it does not apply."""
    # The wording of the tags.
    if not loaded:
        return [F.lit(f"no {label} data")]
    here = F.coalesce(present, F.lit(False))
    usable = here & F.coalesce(valid, F.lit(False))
    return [
        F.when(~here, f"not in {label} dataset"),
        F.when(here & ~F.coalesce(valid, F.lit(False)), f"no valid groups at {label}"),
        F.when(usable & ~has_all_grades, f"missing grade level(s) at {label}"),
        F.when(
            usable & (groups_available < min_groups),
            F.concat(F.lit("only "), groups_available.cast("string"), F.lit(f" groups at {label}")),
        ),
        F.when(
            usable & (min_group_assessed < min_assessed),
            F.concat(F.lit("min "), min_group_assessed.cast("bigint").cast("string"), F.lit(f" assessed/group at {label}")),
        ),
    ]


def year_reason(prefix: str, strict: Column, stable: Column, start: list[Column], end: list[Column]) -> Column:
    """``prefix: tag; tag`` for a failed year, NULL for a good one.

    The tag for an unstable count is left out when an endpoint is missing.
    """
    tags = [*start, *end]
    absent = F.lit(False)
    for side in (start, end):
        for tag in side[:2]:
            absent = absent | tag.isNotNull()
    unstable = F.when(~F.coalesce(stable, F.lit(False)) & ~absent, "unstable count (>25% change)")
    text = F.concat_ws("; ", *tags, unstable)
    text = F.when(text == "", "failed strict validation").otherwise(text)
    return F.when(~F.coalesce(strict, F.lit(False)), F.concat(F.lit(f"{prefix}: "), text))


def exclusion_reason(years: Sequence[Column]) -> Column:
    """Reasons of all years in one text; empty when none failed."""
    return F.concat_ws(" | ", *years)
