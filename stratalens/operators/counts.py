"""Records or wide exports to level counts, and sums over level counts.

Long counts have one row per entity, timepoint and group, with the levels of the
group in one array in scale order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import filled, first_positive, has_negative, level_sum, levels
from ..scales import Group, Scale


def records_to_counts(
    df: DataFrame, keys: Sequence[str | Column], level: Column, size: int, name: str = "counts"
) -> DataFrame:
    """Count records per key and level (``level`` is the ordinal, 1 to ``size``).

    One aggregation with map-side partial counts: a key with a third of all
    records leaves each map task as a single row.
    """
    parts = [F.count_if(level == F.lit(i)).alias(f"_n{i}") for i in range(1, size + 1)]
    counted = df.groupBy(*keys).agg(*parts)
    return counted.select(
        *[c for c in counted.columns if not c.startswith("_n")],
        F.array(*[F.col(f"_n{i}").cast("double") for i in range(1, size + 1)]).alias(name),
    )


def sum_counts(df: DataFrame, keys: Sequence[str | Column], size: int, name: str = "counts") -> DataFrame:
    """Add up count arrays level by level; a level nobody reports stays NULL."""
    parts = [F.sum(c).alias(f"_n{i}") for i, c in enumerate(levels(name, size))]
    summed = df.groupBy(*keys).agg(*parts)
    return summed.select(
        *[c for c in summed.columns if not c.startswith("_n")],
        F.array(*[F.col(f"_n{i}") for i in range(size)]).alias(name),
    )


def wide_to_long(
    df: DataFrame, keys: Sequence[str], groups: Sequence[Group], scale: Scale, column_name=None, convert=None
) -> DataFrame:
    """One column per group and level to one row per group.  No shuffle.

    ``convert`` makes numbers of the cells; it runs on the long rows, where it is
    written once per level and not once per column of a wide export.
    """
    column_name = column_name or (lambda group, level: f"{group.label} {level}")
    convert = convert or (lambda cell: cell.cast("double"))
    kinds = dict(df.dtypes)
    known = {kinds[n] for g in groups for level in scale.levels if (n := column_name(g, level)) in kinds}
    kind = known.pop() if len(known) == 1 else "string"

    def cell(group: Group, level: str) -> Column:
        name = column_name(group, level)
        return (F.col(f"`{name}`") if name in kinds else F.lit(None)).cast(kind)

    rows = F.array(*[
        F.struct(
            F.lit(g.grade).alias("grade"),
            F.lit(g.lang).cast("string").alias("lang"),
            F.array(*[cell(g, level) for level in scale.levels]).alias("_cells"),
        )
        for g in groups
    ])
    long = df.select(*keys, F.inline(rows))
    counts = F.array(*[convert(c) for c in levels("_cells", scale.size)])
    return long.select(*keys, "grade", "lang", counts.alias("counts"))


def long_to_wide(
    df: DataFrame, keys: Sequence[str], groups: Sequence[Group], scale: Scale, values: str = "counts", suffix: str = ""
) -> DataFrame:
    """One row per group back to one column per group and level, in one aggregation."""
    cells = []
    for g in groups:
        here = same_group(g)
        for level, value in zip(scale.levels, levels(values, scale.size), strict=True):
            cells.append(F.max(F.when(here, value)).alias(f"{g.label} {level}{suffix}"))
    return df.groupBy(*keys).agg(*cells)


def same_group(group: Group) -> Column:
    """Predicate: the row belongs to ``group``."""
    return (F.col("grade") == group.grade) & F.col("lang").eqNullSafe(F.lit(group.lang).cast("string"))


def group_label() -> Column:
    """``grade`` or ``grade lang`` of a long row."""
    return F.concat_ws(" ", "grade", "lang")


def derived_total_parts(size: int, chains) -> tuple[list[Column], Column]:
    """Aggregates of the group sums, and the total made of them.

    ``chains`` lists per grade the group labels in order of preference; the
    first with a positive sum counts, the last one otherwise.
    """
    group_sum = F.when(~has_negative(levels("counts", size)), level_sum(levels("counts", size)))
    sums, total = [], F.lit(0.0)
    for position, (_, labels) in enumerate(chains):
        names = [f"_s{position}_{rank}" for rank in range(len(labels))]
        for name, label in zip(names, labels, strict=True):
            sums.append(F.coalesce(F.sum(F.when(group_label() == label, group_sum)), F.lit(0.0)).alias(name))
        total = total + first_positive([F.col(name) for name in names])
    return sums, total


def derived_total(df: DataFrame, keys: Sequence[str], size: int, chains) -> DataFrame:
    """Unique learners per entity from group sums, one language per grade."""
    sums, total = derived_total_parts(size, chains)
    return df.groupBy(*keys).agg(*sums).select(*keys, total.alias("derived_total"))


def largest_language_parts(grades: Sequence[str], size: int, without_top: bool = False) -> tuple[list[Column], Column]:
    """Aggregates of the largest language group per grade, and the total made of them.

    The grades are known, so one aggregation on the entity does; missing counts
    are zero.  ``without_top`` leaves out the best level, giving the pool that may
    be assessed again later.
    """
    parts = levels(filled("counts", size), size)
    group_sum = F.when(~has_negative(parts), level_sum(parts[:-1] if without_top else parts))
    stem = "_pool" if without_top else "_largest"
    cells = [F.max(F.when(F.col("grade") == g, group_sum)).alias(f"{stem}{i}") for i, g in enumerate(grades)]
    return cells, level_sum([F.col(f"{stem}{i}") for i in range(len(grades))])


def largest_language_total(
    df: DataFrame, keys: Sequence[str], grades: Sequence[str], size: int, without_top: bool = False, name: str = "total"
) -> DataFrame:
    """Learners per entity as the sum over grades of the largest language group."""
    cells, total = largest_language_parts(grades, size, without_top)
    return df.groupBy(*keys).agg(*cells).select(*keys, total.alias(name))


def level_range_sum(size: int, low: int, high: int, counts: str = "counts") -> Column:
    """Learners on ordinal levels ``low`` to ``high`` of one group; missing counts as zero."""
    return level_sum(levels(counts, size)[low - 1:high])


def lower_band(df: DataFrame, keys: Sequence[str], size: int, top_level: int, name: str = "lower_band") -> DataFrame:
    """Learners on the lowest ``top_level`` levels, over all groups of an entity."""
    return df.groupBy(*keys).agg(F.sum(level_range_sum(size, 1, top_level)).alias(name))


def upper_counts(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Learners on the two best levels and on the best level, over all groups."""
    return df.groupBy(*keys).agg(
        F.sum(level_range_sum(size, size - 1, size)).alias("upper_count"),
        F.sum(level_range_sum(size, size, size)).alias("top_count"),
    )


def net_gain(df: DataFrame, entity: str, at_start: Column, at_end: Column, size: int) -> DataFrame:
    """End count minus start count of the upper levels; NULL unless both ends exist.

    Both ends come from one aggregation per entity instead of a self-join.
    """
    upper, top = level_range_sum(size, size - 1, size), level_range_sum(size, size, size)
    wide = df.filter(at_start | at_end).groupBy(entity).agg(
        F.sum(F.when(at_start, upper)).alias("_u0"),
        F.sum(F.when(at_end, upper)).alias("_u1"),
        F.sum(F.when(at_start, top)).alias("_t0"),
        F.sum(F.when(at_end, top)).alias("_t1"),
    )
    return wide.select(
        entity,
        (F.col("_u1") - F.col("_u0")).alias("net_gain_upper"),
        (F.col("_t1") - F.col("_t0")).alias("net_gain_top"),
    )
