"""Checks of the data against itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import level_sum, levels
from ..session import materialise


def share_sum_check(shares: DataFrame, by: Sequence[str], size: int, tolerance: float = 0.01) -> DataFrame:
    """Smallest and largest sum of percentages per group, and whether all are 100."""
    total = F.when(F.get("shares", F.lit(0)).isNotNull(), level_sum(levels("shares", size)))
    return shares.groupBy(*by).agg(
        F.count(total).alias("with_data"),
        F.min(total).alias("lowest"),
        F.max(total).alias("highest"),
        F.coalesce(F.bool_and(F.abs(total - 100) <= tolerance), F.lit(True)).alias("all_100"),
    )


def empty_rows(counts: DataFrame, entity: Sequence[str], by: Sequence[str], size: int) -> DataFrame:
    """Entities whose counts are all missing, or all zero or missing, per timepoint."""
    parts = levels("counts", size)
    some = reduce(lambda a, b: a | b, [p.isNotNull() for p in parts])
    per_entity = counts.groupBy(*entity, *by).agg(
        F.bool_or(some).alias("_some"), F.sum(level_sum(parts)).alias("_sum")
    )
    return per_entity.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(~F.col("_some")).alias("all_missing"),
        F.count_if(F.col("_sum") == 0).alias("all_zero"),
    )


def validity_summary(flags: DataFrame, by: Sequence[str]) -> DataFrame:
    """Valid and strictly valid entities per timepoint, as counts and shares."""
    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if("valid").alias("n_valid"),
        F.count_if("valid_strict").alias("n_strict"),
        F.avg(F.col("valid").cast("double")).alias("valid_share"),
        F.avg(F.col("valid_strict").cast("double")).alias("strict_share"),
    )


def null_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and share of missing values of each column, one row per column."""
    cells = [F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"_n{i}") for i, c in enumerate(columns)]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *cells)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("missing_share")) for i, c in enumerate(columns)
    ])
    return wide.select(*by, "rows", F.inline(rows)).withColumn(
        "all_missing", F.col("missing_share") == 1.0
    )


def inventory(counts: DataFrame, by: Sequence[str], size: int) -> DataFrame:
    """Rows, entities and missing level counts per file of the lake."""
    parts = levels("counts", size)
    missing = reduce(lambda a, b: a + b, [p.isNull().cast("bigint") for p in parts])
    per_entity = counts.groupBy(*by, "entity_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(missing).alias("_missing")
    )
    return per_entity.groupBy(*by).agg(
        F.sum("_rows").alias("rows"),
        F.count(F.lit(1)).alias("entities"),
        F.sum("_missing").alias("missing_levels"),
    )


def group_total_difference(counts: DataFrame, assessed: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """How the sum of a group's levels compares with its assessed column, where both are positive."""
    total = level_sum(levels("counts", size))
    joined = counts.select(*keys, total.alias("level_sum")).join(assessed, list(keys))
    both = joined.filter((F.col("level_sum") > 0) & (F.col("assessed") > 0))
    return both.withColumn("difference", F.abs(F.col("level_sum") - F.col("assessed")))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys whose values differ between two tables, or that only one of them has.

    Both tables are stacked and meet in one aggregation, so that neither side
    has to be joined to the other.
    """
    def marked(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(c) for c in columns], F.lit(side).alias("_side"))

    stacked = marked(left, 0).unionByName(marked(right, 1))

    def at(side: int, column: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(column)))

    wide = stacked.groupBy(*keys).agg(
        F.count_if(F.col("_side") == 0).alias("_l"),
        F.count_if(F.col("_side") == 1).alias("_r"),
        *[at(0, c).alias(f"left_{c}") for c in columns],
        *[at(1, c).alias(f"right_{c}") for c in columns],
    )
    changed = reduce(lambda a, b: a | b, [~F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")) for c in columns])
    status = (
        F.when(F.col("_r") == 0, "only_left").when(F.col("_l") == 0, "only_right").when(changed, "differs")
    )
    return wide.withColumn("status", status).filter(F.col("status").isNotNull()).drop("_l", "_r")


def bucket_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, rows, first, second): per bucket of keys the number of rows and two sums of row hashes, which no order of rows changes.

    Hashes are added up before the shuffle, so it moves one row per task and bucket.
    """
    values = [x for c in (*keys, *columns) for x in (F.col(c).isNull(), F.col(c))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")).alias(name) for seed, name in ((1, "first"), (2, "second"))]
    return df.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*(x for k in keys for x in (F.col(k).isNull(), F.col(k)))), F.lit(buckets)).cast("int")


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """The buckets whose sums differ between two tables, written once; at most ``buckets`` rows."""
    sums = [bucket_sums(df, keys, columns, buckets).withColumn("side", F.lit(n)) for n, df in enumerate((left, right))]
    both = sums[0].unionByName(sums[1]).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sides"), *(F.count_distinct(c).alias(c) for c in ("rows", "first", "second"))
    )
    equal = (F.col("sides") == 2) & (F.col("rows") == 1) & (F.col("first") == 1) & (F.col("second") == 1)
    return materialise(both.where(~equal).select("bucket"))


def reconcile_by_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 1 << 14
) -> DataFrame:
    """What ``reconcile`` finds, from the rows of those buckets only whose checksums differ.

    Equal tables exchange checksums and nothing else.  Two 64-bit sums and the number of rows stand for a bucket.
    """
    different = differing_buckets(left, right, keys, columns, buckets)
    if different.isEmpty():
        return reconcile(left.limit(0), right.limit(0), keys, columns)
    # The buckets are as few as asked for, so Spark may send them out whatever the tables hold.
    only = F.broadcast(different)
    inside = lambda df: df.withColumn("bucket", bucket_of(keys, buckets)).join(only, "bucket", "left_semi").drop("bucket")
    return reconcile(inside(left), inside(right), keys, columns)


def profile(df: DataFrame, entity: str, key, timepoint: str, points: Sequence[str]) -> DataFrame:
    """The rows of one entity at the given timepoints; both filters reach the scan."""
    return df.filter((F.col(entity) == key) & F.col(timepoint).isin(list(points)))
