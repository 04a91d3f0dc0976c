"""Segments: labelled pairs of timepoints, from chains given or from the timepoints that data hold.

``build_segments`` and its kin take chains; ``present_segments``, ``present_learning`` and ``present_steps`` are
their twins over a table of timepoints.  Those return a small table (seg_idx, segment_label, segment_kind, tp0, tp1, tp_from, tp_to) that
``operators.shift`` joins, so a year that was never listed anywhere has its segments as soon as it has rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# The periods of a school year, and the known chains.
BEGIN, MIDDLE, END = "BoSY", "MoSY", "EoSY"
DEFAULT_CHAINS = {
    "2024-25": (BEGIN, END),
    "2025-26": (BEGIN, MIDDLE, END),
}


# Chain progress has columns per timepoint; the driver plans no more of them than this.
MOST_TIMEPOINTS = 1000


@dataclass(frozen=True)
class Segment:
    """A labelled pair of timepoints; a timepoint is written ``period year``."""

    index: int
    label: str
    kind: str
    start: str
    end: str
    start_label: str
    end_label: str


def timepoint_label(school_year: str, period: str) -> str:
    return f"{period} {school_year}"


def segment_label(year0: str, period0: str, year1: str, period1: str) -> tuple[str, str]:
    """Label and kind of a pair."""
    # Label patterns.
    if year0 == year1:
        within = {(BEGIN, END): "Learning", (BEGIN, MIDDLE): "BoSYMoSY", (MIDDLE, END): "MoSYEoSY"}
        if (period0, period1) in within:
            return f"{within[period0, period1]}_{year0}", "within_year"
    elif period0 == period1:
        return f"YoY_{period0}_{year0}_to_{year1}", "year_over_year"
    elif (period0, period1) == (BEGIN, END):
        return f"EndToEnd_{year0}_to_{year1}", "end_to_end"
    return f"{period0}_{year0}_to_{period1}_{year1}", "other"


def make_segment(index: int, start: tuple[str, str], end: tuple[str, str]) -> Segment:
    """A segment from two ``(school_year, period)`` pairs."""
    label, kind = segment_label(*start, *end)
    here, there = timepoint_label(*start), timepoint_label(*end)
    return Segment(index, label, kind, here, there, here, there)


def build_segments(chains: Mapping[str, Sequence[str]] = DEFAULT_CHAINS) -> list[Segment]:
    """All segments of the chains.

    Per year: neighbours, and first to last when there is something between.
    Over years: first to last of the same period (begin, end), and the first
    begin to the last end.
    """
    years = sorted(chains)
    pairs = []
    for year in years:
        chain = list(chains[year])
        pairs += [((year, a), (year, b)) for a, b in zip(chain, chain[1:])]
        if len(chain) > 2:
            pairs.append(((year, chain[0]), (year, chain[-1])))
    having = {p: [y for y in years if p in chains[y]] for p in (BEGIN, END)}
    for period in (BEGIN, END):
        if len(having[period]) > 1:
            pairs.append(((having[period][0], period), (having[period][-1], period)))
    if having[BEGIN] and having[END] and having[BEGIN][0] != having[END][-1]:
        pairs.append(((having[BEGIN][0], BEGIN), (having[END][-1], END)))
    return [make_segment(i, a, b) for i, (a, b) in enumerate(dict.fromkeys(pairs))]


def consecutive_segments(points: Sequence[str], prefix: str = "Step") -> list[Segment]:
    """Segments between neighbours of a plain list of timepoints."""
    return [
        Segment(i, f"{prefix}_{a}_to_{b}", "step", a, b, str(a), str(b))
        for i, (a, b) in enumerate(zip(points, points[1:]))
    ]


def learning_segments(chains: Mapping[str, Sequence[str]], years: Sequence[str] | None = None) -> list[Segment]:
    """Begin-to-end segments of each year that has both, numbered without gaps."""
    wanted = [y for y in sorted(years or chains) if BEGIN in chains[y] and END in chains[y]]
    return [make_segment(i, (y, BEGIN), (y, END)) for i, y in enumerate(wanted)]


# From the data ---------------------------------------------------------------------


def present_timepoints(rows: DataFrame) -> DataFrame:
    """The distinct (school_year, period) of a table; one row per timepoint, written once.  NULLs are no timepoint."""
    return materialise(rows.select("school_year", "period").where("school_year IS NOT NULL AND period IS NOT NULL").distinct())


def _labelled(pairs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Number the pairs (y0, p0, y1, p1) in ``order``, without gaps, and name them as ``segment_label`` does."""
    p0, p1 = F.col("p0"), F.col("p1")
    same_year, same_period, whole = F.col("y0") == F.col("y1"), p0 == p1, (p0 == BEGIN) & (p1 == END)
    half = ((p0 == BEGIN) & (p1 == MIDDLE)) | ((p0 == MIDDLE) & (p1 == END))
    across = F.concat(F.col("y0"), F.lit("_to_"), F.col("y1"))
    # Label patterns.
    label = (
        F.when(same_year & whole, F.concat(F.lit("Learning_"), "y0"))
        .when(same_year & half, F.concat(p0, p1, F.lit("_"), "y0"))
        .when(~same_year & same_period, F.concat(F.lit("YoY_"), p0, F.lit("_"), across))
        .when(~same_year & whole, F.concat(F.lit("EndToEnd_"), across))
        .otherwise(F.concat(p0, F.lit("_"), "y0", F.lit("_to_"), p1, F.lit("_"), "y1"))
    )
    kind = (
        F.when(same_year & (whole | half), "within_year")
        .when(~same_year & same_period, "year_over_year").when(~same_year & whole, "end_to_end").otherwise("other")
    )
    start, end = F.concat_ws(" ", p0, "y0"), F.concat_ws(" ", p1, "y1")
    # One row per segment goes through this window.
    number = (F.row_number().over(Window.orderBy(*order)) - 1).alias("seg_idx")
    return materialise(pairs.select(
        number, label.alias("segment_label"), kind.alias("segment_kind"),
        start.alias("tp0"), end.alias("tp1"), start.alias("tp_from"), end.alias("tp_to"),
    ))


def _place(period: Column) -> Column:
    return F.when(period == BEGIN, 0).when(period == MIDDLE, 1).when(period == END, 2).otherwise(3)


def present_segments(timepoints: DataFrame) -> DataFrame:
    """All segments of the timepoints (school_year, period), as ``build_segments`` makes them from chains.

    A period of another name stands behind the known ones of its year.
    """
    year, period = F.col("school_year"), F.col("period")
    of_year = Window.partitionBy("school_year")
    in_year = of_year.orderBy(_place(period), "period")
    placed = timepoints.select("school_year", "period").distinct().select(
        "school_year", "period", F.row_number().over(in_year).alias("i"), F.lead("period").over(in_year).alias("next"),
        F.count("*").over(of_year).alias("length"),
        F.last("period").over(in_year.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"),
    )

    def pairs(df: DataFrame, y0: Column, p0: Column, y1: Column, p1: Column, section: int, i: Column) -> DataFrame:
        return df.select(y0.alias("y0"), p0.alias("p0"), y1.alias("y1"), p1.alias("p1"), F.lit(section).alias("section"), i.alias("i"))

    first, last = F.min(F.when(period == BEGIN, year)), F.max(F.when(period == END, year))
    whole = timepoints.agg(first.alias("first"), last.alias("last")).where("first <> last")
    found = pairs(placed.where("next IS NOT NULL"), year, period, year, F.col("next"), 0, F.col("i"))
    found = found.union(pairs(placed.where("i = 1 AND length > 2"), year, period, year, F.col("last"), 0, F.lit(1 << 30)))
    for section, name in ((1, BEGIN), (2, END)):
        ends = timepoints.where(period == name).agg(F.min("school_year").alias("first"), F.max("school_year").alias("last"))
        found = found.union(pairs(ends.where("first <> last"), F.col("first"), F.lit(name), F.col("last"), F.lit(name), section, F.lit(0)))
    found = found.union(pairs(whole, F.col("first"), F.lit(BEGIN), F.col("last"), F.lit(END), 3, F.lit(0)))
    return _labelled(found, ["section", "y0", "i"])


def present_learning(timepoints: DataFrame) -> DataFrame:
    """Begin-to-end segments of the years that have both, numbered without gaps over the years present."""
    both = timepoints.where(F.col("period").isin(BEGIN, END)).groupBy("school_year").agg(F.count_distinct("period").alias("n"))
    pairs = both.where("n = 2").select(
        F.col("school_year").alias("y0"), F.lit(BEGIN).alias("p0"), F.col("school_year").alias("y1"), F.lit(END).alias("p1")
    )
    return _labelled(pairs, ["y0"])


def present_steps(points: DataFrame, prefix: str = "Step") -> DataFrame:
    """Segments between neighbours of the distinct values of the one column of ``points``, in their order."""
    (name,) = points.columns
    in_order = Window.orderBy("point")
    steps = points.select(F.col(name).cast("string").alias("point")).where("point IS NOT NULL").distinct().select(
        "point", F.lead("point").over(in_order).alias("next"), (F.row_number().over(in_order) - 1).alias("seg_idx")
    )
    return materialise(steps.where("next IS NOT NULL").select(
        "seg_idx", F.concat(F.lit(f"{prefix}_"), "point", F.lit("_to_"), "next").alias("segment_label"), F.lit("step").alias("segment_kind"),
        F.col("point").alias("tp0"), F.col("next").alias("tp1"), F.col("point").alias("tp_from"), F.col("next").alias("tp_to"),
    ))


def present_chain(rows: DataFrame) -> tuple[list[str], list[Segment]]:
    """Labels of all timepoints (school_year, period) of a table in order, and their segments: what ``chain_progress`` plans with.

    The driver holds one row per timepoint.
    """
    known = rows.select("school_year", "period").where("school_year IS NOT NULL AND period IS NOT NULL").distinct()
    found = [(r.school_year, r.period) for r in known.limit(MOST_TIMEPOINTS + 1).collect()]
    if len(found) > MOST_TIMEPOINTS:
        raise ValueError(f"more than {MOST_TIMEPOINTS} timepoints; take the tables per segment instead")
    places = {p: i for i, p in enumerate((BEGIN, MIDDLE, END))}
    found.sort(key=lambda x: (x[0], places.get(x[1], len(places)), x[1]))
    chains: dict[str, list[str]] = {}
    for year, period in found:
        chains.setdefault(year, []).append(period)
    return [timepoint_label(*x) for x in found], build_segments(chains)
