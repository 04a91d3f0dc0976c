"""Timepoint and segment tables of an instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import MOMENTS, count_stable
from ..operators.counts import derived_total_parts, largest_language_total
from ..operators.moments import (
    grade_score_columns,
    group_has_data,
    group_moments,
    group_score_columns,
    share_of_levels,
    top_share,
    with_shares,
)
from ..operators.shift import segment_changes
from ..scales import Instrument
from .segments import BEGIN, Segment

KEYS = ("entity_id", "school_year", "period")


def timepoint_table(
    counts: DataFrame,
    instrument: Instrument,
    keys: Sequence[str] = KEYS,
    scores_by_group: bool = True,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Moments, scores, top-level share and number of full groups per entity and timepoint.

    One aggregation on the keys; everything before it is narrow.  ``extra``
    aggregates ride along in it.
    """
    size = instrument.scale.size
    groups = group_moments(counts, size, instrument.null_as_zero, instrument.zero_sd)
    scores = []
    if scores_by_group:
        scores = group_score_columns(instrument.groups)
        if any(g.lang for g in instrument.groups):
            known = {g.key for g in instrument.groups}
            scores += [
                c for c, grade in zip(grade_score_columns(instrument.groups), instrument.grades, strict=True)
                if grade not in known
            ]
    return groups.groupBy(*keys).agg(
        F.count_if(group_has_data(size)).alias("groups_with_data"),
        *[F.avg(m).alias(m) for m in MOMENTS],
        top_share(size).alias("pct_top_level"),
        *scores,
        *extra,
    )


def timepoints_with_total(counts: DataFrame, reported: DataFrame, instrument: Instrument) -> DataFrame:
    """Timepoint table with ``total_assessed``: the reported total, or one derived from the groups."""
    sums, derived = derived_total_parts(instrument.scale.size, instrument.language_chains)
    table = timepoint_table(counts, instrument, extra=sums).withColumn("_derived", derived)
    totals = reported.groupBy(*KEYS).agg(F.max("reported_total").alias("_reported"))
    joined = table.join(totals, list(KEYS), "left").withColumns({
        "total_assessed": F.coalesce("_reported", "_derived"),
        "total_source": F.when(F.col("_reported").isNotNull(), "reported").otherwise("derived"),
    })
    return joined.drop(*[c for c in joined.columns if c.startswith("_")])


def with_depth(counts7: DataFrame) -> DataFrame:
    """Per group: percentage ready for the grade, and on the three deepest levels (7-level scale)."""
    shares = with_shares(counts7, 7, null_as_zero=True)
    return shares.withColumns({
        "_ready": share_of_levels([6], 7), "_deep": share_of_levels([0, 1, 2], 7)
    }).drop("shares")


def depth_aggregates() -> list[Column]:
    """Aggregates over the columns of ``with_depth``."""
    return [F.avg("_ready").alias("pct_grade_ready"), F.avg("_deep").alias("pct_3ld")]


def begin_depth(counts7: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean depth shares per entity and timepoint."""
    return with_depth(counts7).groupBy(*keys).agg(*depth_aggregates())


def begin_total(
    counts7: DataFrame, grades: Sequence[str], assessed: DataFrame | None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Learners at the begin of the year.

    From the per-grade ``assessed`` column where the export has one per grade;
    otherwise the sum over grades of the larger language.
    """
    if assessed is not None:
        return assessed.groupBy(*keys).agg(
            F.sum(F.coalesce(F.col("assessed"), F.lit(0.0))).alias("total_assessed")
        )
    return largest_language_total(counts7, keys, grades, 7, name="total_assessed")


def segment_table(
    counts: DataFrame,
    instrument: Instrument,
    segments: Sequence[Segment] | DataFrame,
    entity: Sequence[str] = ("entity_id",),
    keep: str = "start",
) -> DataFrame:
    """Deltas and distances per entity and segment; one row per entity present at the start."""
    labelled = counts.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    return segment_changes(
        labelled,
        list(entity),
        ["grade", "lang"],
        "timepoint_label",
        segments,
        instrument.scale.size,
        instrument.null_as_zero,
        instrument.zero_sd,
        keep,
    )


def year_over_year(
    counts7: DataFrame,
    totals: DataFrame,
    instrument7: Instrument,
    segment: Segment,
    threshold: float = 0.25,
) -> DataFrame:
    """Begin-of-year comparison on the 7-level scale, entities present in both years.

    ``count_stable`` is for information only.
    """
    changes = segment_table(counts7, instrument7, [segment], keep="both")
    labelled = counts7.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    depth = begin_depth(
        labelled.filter(F.col("period") == BEGIN), ("entity_id", "timepoint_label")
    )
    marked = totals.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))

    def both(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        at0, at1 = (F.col("timepoint_label") == p for p in (segment.start, segment.end))
        return df.groupBy("entity_id").agg(*[
            F.max(F.when(at, F.col(c))).alias(f"{c}_{i}") for c in columns for i, at in enumerate((at0, at1))
        ])

    return (
        changes.join(both(depth, ("pct_grade_ready", "pct_3ld")), "entity_id", "left")
        .join(both(marked, ("total_assessed",)), "entity_id", "left")
        .select(
            "entity_id",
            "delta_mean",
            "delta_sd",
            "delta_skew",
            (F.col("pct_grade_ready_1") - F.col("pct_grade_ready_0")).alias("delta_pct_grade_ready"),
            (F.col("pct_3ld_1") - F.col("pct_3ld_0")).alias("delta_pct_3ld"),
            "emd_mean",
            count_stable(F.col("total_assessed_0"), F.col("total_assessed_1"), threshold).alias("count_stable"),
        )
    )
