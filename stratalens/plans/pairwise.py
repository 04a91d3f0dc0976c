"""Wide comparison of two timepoints: flags, scores, progress and level breakdown per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import levels
from ..operators.counts import group_label
from ..operators.keysets import first_known
from ..operators.moments import with_shares
from ..operators.validity import count_mismatch
from ..scales import Instrument
from .segments import Segment


def pairwise_table(
    counts: DataFrame,
    scores: DataFrame,
    instrument: Instrument,
    segment: Segment,
    entity: str = "entity_id",
    weights: Mapping[str, float] | None = None,
    metadata: Sequence[str] = (),
    threshold: float = 0.25,
    unknown_is_mismatch: bool = True,
    timepoint: str = "timepoint_label",
) -> DataFrame:
    """One row per entity present at either timepoint of the segment.

    ``counts`` are long counts with ``timepoint``; ``scores`` has ``perf``,
    ``valid``, ``total_assessed`` and the metadata per entity and timepoint.
    Column names follow the export: flags, scores and ``Progress Score``, then
    per timepoint and level the mean over groups, each group, and the weighted
    mean.  Two aggregations by entity and one join between them.
    """
    ends = (segment.start, segment.end)
    at = (F.col(timepoint) == F.lit(segment.start), F.col(timepoint) == F.lit(segment.end))
    return _compared(
        counts.filter(F.col(timepoint).isin(*ends)), scores.filter(F.col(timepoint).isin(*ends)), instrument, [entity], at,
        (segment.start_label, segment.end_label), weights, metadata, threshold, unknown_is_mismatch,
    )


def pairwise_rows(
    counts: DataFrame,
    scores: DataFrame,
    instrument: Instrument,
    segments: DataFrame,
    entity: str = "entity_id",
    weights: Mapping[str, float] | None = None,
    metadata: Sequence[str] = (),
    threshold: float = 0.25,
    unknown_is_mismatch: bool = True,
    timepoint: str = "timepoint_label",
) -> DataFrame:
    """The comparisons of all segments as rows (segment_label, tp_from, tp_to, entity, ...), in one pass.

    Each row of counts and scores goes to the segments it starts or ends, and entity and segment are the key of what
    ``pairwise_table`` does for one.  Columns say ``From`` and ``To`` instead of timepoints.  ``segments`` is a table as
    ``present_segments`` makes it.
    """
    points = F.array(*(F.struct(F.col(p).alias("_point"), F.lit(n).alias("_side")) for n, p in enumerate(("tp0", "tp1"))))
    sides = segments.select("seg_idx", F.inline(points))

    def sided(df: DataFrame) -> DataFrame:
        return df.join(sides, F.col(timepoint) == F.col("_point")).drop("_point")

    at = (F.col("_side") == 0, F.col("_side") == 1)
    table = _compared(
        sided(counts), sided(scores), instrument, [entity, "seg_idx"], at, ("From", "To"), weights, metadata, threshold, unknown_is_mismatch
    )
    named = table.join(segments.select("seg_idx", "segment_label", "tp_from", "tp_to"), "seg_idx").drop("seg_idx")
    head = ["segment_label", "tp_from", "tp_to"]
    return named.select(*head, *[F.col(f"`{c}`") for c in named.columns if c not in head])


def _compared(
    counts: DataFrame,
    scores: DataFrame,
    instrument: Instrument,
    by: Sequence[str],
    at: tuple[Column, Column],
    labels: tuple[str, str],
    weights: Mapping[str, float] | None,
    metadata: Sequence[str],
    threshold: float,
    unknown_is_mismatch: bool,
) -> DataFrame:
    """Flags, scores and level breakdown of two sides per key; ``at`` says which rows are of which side."""
    size = instrument.scale.size
    order = F.when(at[0], 0).otherwise(1)
    cells = [*first_known(metadata, order)]
    for i in (0, 1):
        cells += [
            F.max(F.when(at[i], F.col("perf"))).alias(f"_perf{i}"),
            F.coalesce(F.bool_or(F.when(at[i], F.col("valid"))), F.lit(False)).alias(f"_valid{i}"),
            F.max(F.when(at[i], F.col("total_assessed"))).alias(f"_n{i}"),
        ]
    sides = scores.groupBy(*by).agg(*cells)
    mismatch = count_mismatch(F.col("_n0"), F.col("_n1"), threshold, unknown_is_mismatch)
    usable = F.col("_valid0") & F.col("_valid1") & ~F.col("Student Count Mismatch")
    head = sides.withColumn("Student Count Mismatch", mismatch).withColumn("Valid for Progress Analysis", usable)

    shares = with_shares(counts, size, instrument.null_as_zero)
    parts = levels("shares", size)
    names = instrument.scale.levels
    sequence = [names.index(x) for x in instrument.export_levels or names]
    breakdown: list[Column] = []
    for i, label in enumerate(labels):
        for k in sequence:
            breakdown.append(F.avg(F.when(at[i], parts[k])).alias(f"{label} {names[k]} %"))
            for g in instrument.groups:
                here = at[i] & (group_label() == g.label)
                breakdown.append(F.max(F.when(here, parts[k])).alias(f"{label} {g.label} {names[k]}"))
    table = shares.groupBy(*by).agg(*breakdown)
    weighted = {}
    for label in labels:
        for k in sequence:
            if weights and names[k] in weights:
                weighted[f"{label} {names[k]} Weighted"] = F.col(f"`{label} {names[k]} %`") * (weights[names[k]] / 100.0)
    if weighted:
        table = table.withColumns(weighted)
    blocks = []
    for label in labels:
        for k in sequence:
            blocks += [f"{label} {names[k]} %", *[f"{label} {g.label} {names[k]}" for g in instrument.groups]]
        blocks += [f"{label} {names[k]} Weighted" for k in sequence if f"{label} {names[k]} Weighted" in weighted]
    return head.join(table, list(by), "left").select(
        *by,
        *metadata,
        F.col("_valid0").alias(f"Has {labels[0]} Data"),
        F.col("_valid1").alias(f"Has {labels[1]} Data"),
        "Student Count Mismatch",
        "Valid for Progress Analysis",
        F.col("_perf0").alias(f"{labels[0]} Performance"),
        F.col("_perf1").alias(f"{labels[1]} Performance"),
        F.when(F.col("Valid for Progress Analysis"), F.col("_perf1") - F.col("_perf0")).alias("Progress Score"),
        *[F.col(f"`{b}`") for b in blocks],
    )
