"""Chain progress: scores of every timepoint and deltas of every segment, per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import count_stable
from ..operators.keysets import first_known
from .segments import Segment

SCORES = ("perf", "sd", "skew")


def chain_progress(
    timepoints: DataFrame,
    entity: str,
    points: Sequence[str],
    segments: Sequence[Segment],
    metadata: Sequence[str] = (),
    threshold: float = 0.25,
    timepoint: str = "timepoint_label",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One wide row per entity, from one aggregation.

    ``timepoints`` has one row per entity and timepoint with ``perf``, ``sd``,
    ``skew``, ``valid``, ``valid_strict`` and ``total_assessed``.  A delta needs
    both ends valid and a stable count.  Columns: ``<score>_<i>`` (and those in
    ``carry``) per timepoint, with ``present_<i>`` for a row at that timepoint,
    ``seg<n>_delta|sd_delta|skew_delta|valid|count_stable|valid_strict`` per
    segment (1-based), counts of usable segments and the sums over full-year
    segments.
    """
    number = {p: i for i, p in enumerate(points)}
    order = F.array_position(F.array(*[F.lit(p) for p in points]), F.col(timepoint))
    cells = []
    for p, i in number.items():
        here = f"`{timepoint}` = '{p}'"
        cells.append(F.expr(f"coalesce(bool_or({here}), false) AS present_{i}"))
        for c in dict.fromkeys((*SCORES, "total_assessed", "valid", "valid_strict", *carry)):
            cells.append(F.expr(f"max(CASE WHEN {here} THEN {c} END) AS {c}_{i}"))
    wide = timepoints.groupBy(entity).agg(*first_known(metadata, order), *cells)

    stable, checks, deltas = {}, {}, {}
    for n, s in enumerate(segments, start=1):
        i, j = number[s.start], number[s.end]
        stable[f"seg{n}_count_stable"] = count_stable(
            F.col(f"total_assessed_{i}"), F.col(f"total_assessed_{j}"), threshold
        )
        for flag in ("valid", "valid_strict"):
            checks[f"seg{n}_{flag}"] = F.expr(
                f"coalesce({flag}_{i}, false) AND coalesce({flag}_{j}, false) AND seg{n}_count_stable"
            )
        for score, name in zip(SCORES, ("delta", "sd_delta", "skew_delta"), strict=True):
            deltas[f"seg{n}_{name}"] = F.expr(f"CASE WHEN seg{n}_valid THEN {score}_{j} - {score}_{i} END")
    wide = wide.withColumns(stable).withColumns(checks).withColumns(deltas)

    numbers = range(1, len(segments) + 1)
    full_year = [n for n, s in enumerate(segments, start=1) if s.label.startswith("Learning_")]

    def tally(flag: str) -> Column:
        return F.expr(" + ".join(f"CAST(seg{n}_{flag} AS INT)" for n in numbers) or "0")

    def composite(name: str) -> Column:
        if not full_year:
            return F.lit(None).cast("double")
        parts = [f"seg{n}_{name}" for n in full_year]
        total = " + ".join(f"coalesce({p}, 0.0D)" for p in parts)
        return F.expr(f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN {total} END")

    return wide.withColumns({
        "segments_available": tally("valid"),
        "segments_available_strict": tally("valid_strict"),
        "composite_score": composite("delta"),
        "composite_sd_delta": composite("sd_delta"),
        "composite_skew_delta": composite("skew_delta"),
    })


def chain_long(progress: DataFrame, entity: str, segments: Sequence[Segment]) -> DataFrame:
    """The segment columns of chain progress as rows."""
    names = ("delta", "sd_delta", "skew_delta", "valid", "count_stable", "valid_strict")
    rows = F.array(*[
        F.struct(
            F.lit(s.index).alias("seg_idx"),
            F.lit(s.label).alias("segment_label"),
            *[F.col(f"seg{n}_{name}").alias(name) for name in names],
        )
        for n, s in enumerate(segments, start=1)
    ])
    return progress.select(entity, F.inline(rows))


def segment_summary(long: DataFrame) -> DataFrame:
    """Valid and strict counts and the mean delta per segment."""
    return long.groupBy("seg_idx", "segment_label").agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if("valid").alias("n_valid"),
        F.count_if("valid_strict").alias("n_strict"),
        F.avg("delta").alias("mean_delta"),
    )
