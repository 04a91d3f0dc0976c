"""Priority ranking of entities by need, impact and local capacity gap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import priority_band
from ..operators.keysets import flag_members, keep_first, without_members
from ..operators.ranks import percentile_ranks, z_scores
from ..session import materialise
from .segments import Segment

# Default weights of the need components.
NEED_WEIGHTS = {
    "level_mean": 2.0,
    "delta_mean": 2.0,
    "level_sd": 1.0,
    "level_skew": 1.0,
    "delta_sd": 0.5,
    "delta_skew": 0.5,
}
REQUIRED = ("mean_end", "delta_mean", "assessed_count", "fund_per_learner")
SECONDARY = ("sd_end", "skew_end", "delta_sd", "delta_skew")
NOWHERE_SALTS = 1 << 14


def area_capacity(
    crosswalk: DataFrame, funds: DataFrame, entity: str, area: str, enrollment: DataFrame | None = None
) -> DataFrame:
    """Fund per learner of each area.

    ``crosswalk`` maps entities to areas, ``funds`` has ``area``, ``area_name``
    and ``fund`` (its first row per area by name counts), ``enrollment`` has
    ``entity`` and ``enrolled``.  Without enrollment the area's entities are
    counted instead.
    """
    mapped = crosswalk.select(entity, area).filter(F.col(area).isNotNull()).distinct()
    if enrollment is not None:
        # A school listed twice counts once, with the larger number.
        per_entity = enrollment.groupBy(entity).agg(F.max("enrolled").alias("enrolled"))
        learners = mapped.join(per_entity, entity).groupBy(area).agg(
            F.sum("enrolled").cast("double").alias("area_enrolled")
        )
    else:
        learners = mapped.groupBy(area).agg(F.count(F.lit(1)).cast("double").alias("area_enrolled"))
    unique = keep_first(funds.select(area, "area_name", "fund"), [area], [F.col("area_name"), F.col("fund")])
    return unique.join(learners, area, "left").withColumn(
        "fund_per_learner", F.try_divide("fund", "area_enrolled")
    )


def with_capacity(df: DataFrame, crosswalk: DataFrame, capacity: DataFrame, entity: str, area: str) -> DataFrame:
    """Add the crosswalk columns of each entity and its area's capacity; entities without an area keep their row."""
    # Rows without an area are dealt out by entity; under one NULL key they would meet in one task.  The second key of the
    # others follows from their area: the optimiser would take a constant out of the join.
    spread = lambda c: F.pmod(F.xxhash64(c), F.lit(NOWHERE_SALTS))
    located = df.join(crosswalk, entity, "left").withColumn("_salt", F.when(F.col(area).isNull(), spread(entity)).otherwise(spread(area)))
    return located.join(capacity.withColumn("_salt", spread(area)), [area, "_salt"], "left").drop("_salt")


def segment_inputs(
    progress: DataFrame, entity: str, segment: int, end: int, columns: Sequence[str] = (), digits: int = 9
) -> DataFrame:
    """Ranking inputs of one segment: entities that pass the strict check at both ends.

    ``segment`` is the 1-based segment number and ``end`` the position of its
    end timepoint in chain progress.  Moments are rounded to ``digits``, so that
    ties do not hang on the order in which a sum was taken.
    """

    def near(name: str) -> Column:
        return F.round(F.col(name), digits)

    return progress.filter(F.col(f"seg{segment}_valid_strict")).select(
        entity,
        *columns,
        near(f"perf_{end}").alias("mean_end"),
        near(f"sd_{end}").alias("sd_end"),
        near(f"skew_{end}").alias("skew_end"),
        near(f"seg{segment}_delta").alias("delta_mean"),
        near(f"seg{segment}_sd_delta").alias("delta_sd"),
        near(f"seg{segment}_skew_delta").alias("delta_skew"),
        F.col(f"total_assessed_{end}").alias("assessed_count"),
    )


def composite_inputs(
    progress: DataFrame, entity: str, segments: Sequence[int], end: int, columns: Sequence[str] = (), digits: int = 9
) -> DataFrame:
    """Ranking inputs over several full-year segments: strict in all, deltas averaged.

    A missing delta of sd or skewness counts as zero in its average.
    """
    strict = reduce(lambda a, b: a & b, [F.col(f"seg{n}_valid_strict") for n in segments])

    def near(value: Column) -> Column:
        return F.round(value, digits)

    def average(name: str, zero: bool) -> Column:
        parts = [F.col(f"seg{n}_{name}") for n in segments]
        if zero:
            parts = [F.coalesce(p, F.lit(0.0)) for p in parts]
        return near(reduce(lambda a, b: a + b, parts) / float(len(parts)))

    return progress.filter(strict).select(
        entity,
        *columns,
        near(F.col(f"perf_{end}")).alias("mean_end"),
        near(F.col(f"sd_{end}")).alias("sd_end"),
        near(F.col(f"skew_{end}")).alias("skew_end"),
        *[near(F.col(f"seg{n}_delta")).alias(f"delta_mean_{n}") for n in segments],
        average("delta", False).alias("delta_mean"),
        average("sd_delta", True).alias("delta_sd"),
        average("skew_delta", True).alias("delta_skew"),
        F.col(f"total_assessed_{end}").alias("assessed_count"),
    )


def need_components(top_level: float = 5.0) -> dict[str, Column]:
    """The six need components before standardising, higher meaning more need."""
    return {
        "level_mean": top_level - F.col("mean_end"),
        "delta_mean": -F.col("delta_mean"),
        "level_sd": F.col("sd_end"),
        "level_skew": F.col("skew_end"),
        "delta_sd": F.col("delta_sd"),
        "delta_skew": F.col("delta_skew"),
    }


def complete_inputs(inputs: DataFrame) -> DataFrame:
    """Drop entities that miss a required input; other missing components count as zero."""
    kept = inputs.dropna(subset=list(REQUIRED))
    return kept.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in SECONDARY})


def pillar_scores(
    inputs: DataFrame, weights: Mapping[str, float] = NEED_WEIGHTS, top_level: float = 5.0
) -> DataFrame:
    """Need, impact and capacity gap; the standardised components stay as ``z_<component>``.

    ``inputs`` is read twice (once for the means and deviations).
    """
    parts = need_components(top_level)
    staged = inputs.withColumns({
        **{f"_{name}": c for name, c in parts.items()}, "_gap": -F.col("fund_per_learner")
    })
    scored = z_scores(staged, [*[f"_{name}" for name in parts], "_gap"])
    need = reduce(lambda a, b: a + b, [float(weights[n]) * F.col(f"_{n}_z") for n in parts])
    scored = scored.withColumns({
        "need_score": need,
        "impact_score": F.col("assessed_count"),
        "capacity_gap_score": F.col("_gap_z"),
        **{f"z_{n}": F.col(f"_{n}_z") for n in parts},
    })
    return scored.drop(*[f"_{n}" for n in parts], *[f"_{n}_z" for n in parts], "_gap", "_gap_z")


def rank_entities(
    inputs: DataFrame, entity: str, weights: Mapping[str, float] = NEED_WEIGHTS, top_level: float = 5.0
) -> DataFrame:
    """Percentile ranks of the pillars, their product, its percentile rank and band, in order of priority.

    The inputs are written once and read by the passes for means, ladder and
    ranks; ranks never gather a column in one task (see ``operators.ranks``).
    """
    base = materialise(complete_inputs(inputs))
    pillars = percentile_ranks(pillar_scores(base, weights, top_level), {
        "need_score": "need_pctile",
        "impact_score": "impact_pctile",
        "capacity_gap_score": "capacity_gap_pctile",
    })
    scored = materialise(pillars.withColumn(
        "priority_score", F.col("need_pctile") * F.col("impact_pctile") * F.col("capacity_gap_pctile")
    ))
    ranked = percentile_ranks(scored, {"priority_score": "priority_pctile"})
    ranked = ranked.withColumn("priority_band", priority_band(F.col("priority_pctile")))
    return ranked.orderBy(F.desc("priority_score"), F.asc(entity))


def ranking_summary(inputs: DataFrame) -> DataFrame:
    """How many entities pass the strict check, miss an input, and are ranked."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED])
    return inputs.agg(
        F.count(F.lit(1)).alias("strict_valid"),
        F.count_if(~complete).alias("dropped_missing_data"),
        F.count_if(complete).alias("ranked"),
    )


def coverage_funnel(progress: DataFrame, points: Sequence[str], segments: Sequence[Segment]) -> DataFrame:
    """How many entities of each segment are there, valid, strictly valid, scored and ranked, in one aggregation.

    ``progress`` is chain progress with ``fund_per_learner``.  Each entity gives one row per segment with a mask of the
    stages it reaches; ranked are those that ``ranking_summary`` would rank for that segment.
    """
    stages = ("valid", "strict", "scored", "ranked")

    def mask(n: int, end: int) -> Column:
        strict, delta = F.coalesce(F.col(f"seg{n}_valid_strict"), F.lit(False)), F.col(f"seg{n}_delta").isNotNull()
        needed = [F.col(c).isNotNull() for c in (f"perf_{end}", f"total_assessed_{end}", "fund_per_learner")]
        reached = (F.coalesce(F.col(f"seg{n}_valid"), F.lit(False)), strict, delta, reduce(lambda a, b: a & b, needed, strict & delta))
        return reduce(lambda a, b: a + b, (r.cast("int") * (1 << k) for k, r in enumerate(reached)))

    rows = F.array(*(
        F.struct(F.lit(s.label).alias("segment_label"), mask(n, points.index(s.end)).alias("mask")) for n, s in enumerate(segments, start=1)
    ))
    return progress.select(F.inline(rows)).groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.col("mask").bitwiseAND(1 << k) > 0).alias(stage) for k, stage in enumerate(stages)),
    )


def priority_list(ranked: DataFrame, entity: str, n: int = 100, cohort: DataFrame | None = None) -> DataFrame:
    """The ``n`` entities of highest priority, without those of an earlier cohort."""
    pool = ranked if cohort is None else without_members(ranked, cohort, entity)
    return pool.orderBy(F.desc("priority_score"), F.asc(entity)).limit(n)


def tag_cohort(ranked: DataFrame, cohort: DataFrame, entity: str) -> DataFrame:
    """Mark the members of an earlier cohort in the ranking."""
    return flag_members(ranked, cohort, entity, "is_first_cycle")
