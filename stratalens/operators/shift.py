"""What changed between two timepoints of the same entity.

Moments are computed once per group and timepoint, however many segments use
them.  Each row then goes to the segments it starts or ends, and one shuffle by
entity serves both aggregations that follow: start and end of a group side by
side, then groups to entities.  There is no self-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import earth_mover, levels
from ..plans.segments import Segment
from .moments import group_moments

MOVING = {"ordinal_mean": "delta_mean", "ordinal_sd": "delta_sd", "ordinal_skew": "delta_skew"}


def segment_sides(timepoint: str, segments: Sequence[Segment]) -> Column:
    """The ``(seg_idx, is_end)`` pairs a timepoint takes part in."""
    sides = []
    for s in segments:
        for point, is_end in ((s.start, False), (s.end, True)):
            here = F.struct(F.lit(s.index).alias("seg_idx"), F.lit(is_end).alias("is_end"))
            sides.append(F.when(F.col(timepoint) == F.lit(point), here))
    return F.array_compact(F.array(*sides))


def segment_attributes(segments: Sequence[Segment]) -> dict[str, Column]:
    """Label columns of a segment, looked up by ``seg_idx``."""

    def lookup(values) -> Column:
        table = F.create_map(*[F.lit(x) for s, v in zip(segments, values, strict=True) for x in (s.index, v)])
        return F.try_element_at(table, F.col("seg_idx"))

    return {
        "segment_label": lookup([s.label for s in segments]),
        "segment_kind": lookup([s.kind for s in segments]),
        "tp_from": lookup([s.start_label for s in segments]),
        "tp_to": lookup([s.end_label for s in segments]),
    }


def _sided(moments: DataFrame, timepoint: str, segments: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """``columns`` of the rows at both sides of the segments of a table; Spark sends that table out by its size."""
    ends = F.array(*(F.struct(F.col(p).alias("_point"), F.lit(is_end).alias("is_end")) for p, is_end in (("tp0", False), ("tp1", True))))
    sides = segments.select("seg_idx", F.inline(ends))
    return moments.join(sides, F.col(timepoint) == F.col("_point")).select(*columns, "seg_idx", "is_end")


def segment_changes(
    df: DataFrame,
    entity: Sequence[str],
    group: Sequence[str],
    timepoint: str,
    segments: Sequence[Segment] | DataFrame,
    size: int,
    null_as_zero: bool = False,
    zero_sd: str = "keep",
    keep: str = "start",
) -> DataFrame:
    """Deltas of mean, sd and skewness and the mean earth mover's distance per entity and segment.

    ``segments`` is a list, or a table as ``plans.segments.present_segments`` makes it from the data.
    ``keep`` says which entities get a row: those present at the ``start``, at
    ``both`` ends, or at ``either`` end.  A delta uses each end's own groups;
    the distance only groups complete at both ends (``groups_common`` of them).
    """
    if keep not in ("start", "both", "either"):
        raise ValueError(f"unknown keep {keep!r}")
    listed = not isinstance(segments, DataFrame)
    if listed:
        df = df.filter(F.col(timepoint).isin(list(dict.fromkeys(p for s in segments for p in (s.start, s.end)))))
    moments = group_moments(df, size, null_as_zero, zero_sd)
    parts = {f"p{i}": c for i, c in enumerate(levels("shares", size))}
    columns = [*entity, *group, *MOVING, *[c.alias(n) for n, c in parts.items()]]
    if listed:
        sided = moments.select(*columns, F.inline(segment_sides(timepoint, segments)))
    else:
        sided = _sided(moments, timepoint, segments, columns)
    sided = sided.repartition(*entity)

    start, end = ~F.col("is_end"), F.col("is_end")
    cells = [F.bool_or(start).alias("_start"), F.bool_or(end).alias("_end")]
    for name in (*parts, *MOVING):
        cells += [F.max(F.when(start, F.col(name))).alias(f"{name}_0"), F.max(F.when(end, F.col(name))).alias(f"{name}_1")]
    per_group = sided.groupBy(*entity, "seg_idx", *group).agg(*cells)
    distance = earth_mover([F.col(f"{n}_0") for n in parts], [F.col(f"{n}_1") for n in parts])
    per_entity = per_group.withColumn("_emd", distance).groupBy(*entity, "seg_idx").agg(
        F.bool_or("_start").alias("_start"),
        F.bool_or("_end").alias("_end"),
        *[(F.avg(f"{m}_1") - F.avg(f"{m}_0")).alias(name) for m, name in MOVING.items()],
        F.avg("_emd").alias("emd_mean"),
        F.count("_emd").alias("groups_common"),
    )
    wanted = {
        "start": F.col("_start"),
        "both": F.col("_start") & F.col("_end"),
        "either": F.lit(True),
    }[keep]
    kept = per_entity.filter(wanted)
    if listed:
        kept = kept.withColumns(segment_attributes(segments))
    else:
        kept = kept.join(segments.select("seg_idx", "segment_label", "segment_kind", "tp_from", "tp_to"), "seg_idx")
    return kept.select(
        *entity, "seg_idx", "segment_label", "segment_kind", "tp_from", "tp_to",
        *MOVING.values(), "emd_mean", "groups_common",
    )
