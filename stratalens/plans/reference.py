"""Reference table: every entity with its validity, scores, counts and reason for exclusion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keysets import flag_members
from ..operators.validity import MIN_ASSESSED, MIN_GROUPS, endpoint_tags, exclusion_reason, year_reason
from .segments import BEGIN, END


def yes_no(flag: Column, no: str = "No") -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), "Yes").otherwise(no)


# What chain progress must carry for the reasons.
REASON_FIELDS = ("has_all_grades", "groups_available", "min_group_assessed")


@dataclass(frozen=True)
class ReportYear:
    """A school year of the report: heading, column suffix, endpoints and 1-based segment number."""

    heading: str
    suffix: str
    start: str
    end: str
    segment: int
    start_name: str = BEGIN
    end_name: str = END


def with_reasons(
    progress: DataFrame,
    years: Sequence[ReportYear],
    points: Sequence[str],
    loaded: Sequence[str] | None = None,
    min_groups: int = MIN_GROUPS,
    min_assessed: int = MIN_ASSESSED,
) -> DataFrame:
    """Add ``exclusion_reason`` to chain progress that carries ``REASON_FIELDS``.  Row-wise.

    ``points`` are the timepoints in the order given to chain progress;
    ``loaded`` those for which there is data at all.
    """

    def tags(point: str, name: str) -> list[Column]:
        i = list(points).index(point)
        known = loaded is None or point in loaded
        fields = [F.col(f"{f}_{i}") for f in ("present", "valid", *REASON_FIELDS)]
        return endpoint_tags(*fields, name, known, min_groups, min_assessed)

    reasons = [
        year_reason(
            y.heading,
            F.col(f"seg{y.segment}_valid_strict"),
            F.col(f"seg{y.segment}_count_stable"),
            tags(y.start, y.start_name),
            tags(y.end, y.end_name),
        )
        for y in years
    ]
    return progress.withColumn("exclusion_reason", exclusion_reason(reasons))


def reference_table(
    progress: DataFrame,
    entity: str,
    years: Sequence[ReportYear],
    cohort: DataFrame,
    columns: Sequence[str | Column] = (),
) -> DataFrame:
    """All entities with Yes/No columns per year, for the composite and for the cohort list."""
    flagged = flag_members(progress, cohort, entity, "_cohort")
    every = F.lit(True)
    for y in years:
        every = every & F.coalesce(F.col(f"seg{y.segment}_valid_strict"), F.lit(False))
    return flagged.select(
        entity,
        *columns,
        *[yes_no(F.col(f"seg{y.segment}_valid_strict")).alias(f"valid_{y.suffix}") for y in years],
        yes_no(every).alias("valid_composite"),
        yes_no(F.col("_cohort"), no="").alias("in_cohort"),
        *[F.col(f"seg{y.segment}_delta").alias(f"delta_mean_{y.suffix}") for y in years],
        "exclusion_reason",
    )


def reference_order(name: str, entity: str) -> list[Column]:
    """Valid entities first, cohort members first among them, then by name."""
    return [F.desc("valid_composite"), F.desc("in_cohort"), F.asc(name), F.asc(entity)]


def validity_crosstab(reference: DataFrame, first: str, second: str) -> DataFrame:
    """How many entities are valid in one year, the other, both or neither, and how many are in the cohort."""
    return reference.groupBy(first, second).agg(
        F.count(F.lit(1)).alias("entities"), F.count_if(F.col("in_cohort") == "Yes").alias("in_cohort")
    )
