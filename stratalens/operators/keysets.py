"""Key sets over timepoints, and first known values in timepoint order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_known(columns: Sequence[str], order: Column) -> list[Column]:
    """Aggregates: per column, its first non-NULL value by ``order``."""
    return [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]


def key_union(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct keys of all frames."""
    out = frames[0].select(key)
    for frame in frames[1:]:
        out = out.union(frame.select(key))
    return out.distinct()


def presence(df: DataFrame, key: str, timepoint: str) -> DataFrame:
    """Per key, the number of timepoints it was seen at."""
    return df.groupBy(key).agg(F.count_distinct(timepoint).alias("timepoints_seen"))


def presence_matrix(df: DataFrame, key: str, sets: dict[str, Column]) -> DataFrame:
    """One row per key with a flag per named set: unions, intersections and differences are filters on it."""
    return df.groupBy(key).agg(*[
        F.coalesce(F.bool_or(condition), F.lit(False)).alias(f"in_{name}") for name, condition in sets.items()
    ])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in a stated order.

    An aggregation rather than a window: partial minima leave each map task, so
    a key with very many copies is never sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("_first")
    )
    return picked.select(*keys, "_first.*").select(*df.columns)


def top_n_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group; Spark prunes to ``n`` per group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("position", rank).filter(F.col("position") <= n)


def flag_members(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """Mark the rows whose key is in a list.  The list is made distinct first."""
    listed = members.select(key).distinct().withColumn("_listed", F.lit(True))
    return df.join(listed, key, "left").withColumn(flag, F.coalesce(F.col("_listed"), F.lit(False))).drop("_listed")


def without_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in a list."""
    return df.join(members.select(key).distinct(), key, "left_anti")
