"""Ranks and exact quantiles without bringing a column into one task.

A window without partition keys sorts all rows in a single task, and the exact
``percentile`` aggregate keeps all distinct values in one.  Here equal values are
first merged (with map-side combining, so that a value shared by a third of all
rows costs one row per map task).  The distinct values are range-partitioned and
written as a table together with the number of their range, which fixes the
ranges for good.  Counts below a value are then a running sum inside
its range plus the total of all earlier ranges; only these totals, one row per
range, meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROW_LIMIT, materialise

HEAVY_VALUE_LIMIT = 1000
SALTS = 1024


@dataclass(frozen=True)
class Ladder:
    """Distinct values in order, with the number of rungs and of rows behind them.

    Columns of ``df``: the group columns, the value, ``n`` rows that have it,
    ``below`` rows of the group under it, ``total`` rows of the group.
    """

    df: DataFrame
    rungs: int
    rows: int


def value_ladder(df: DataFrame, value: str, by: Sequence[str] = ()) -> Ladder:
    """Order the distinct non-NULL values of a column, per group if ``by`` is given."""
    by = list(by)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    # Spark chooses the number of ranges (at most spark.sql.shuffle.partitions) by their size.
    laid_out = materialise(
        counted.repartitionByRange(*by, value).withColumn("_range", F.spark_partition_id())
    )
    size = laid_out.agg(F.count(F.lit(1)).alias("rungs"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    totals = laid_out.groupBy(*by, "_range").agg(F.sum("n").alias("_in_range"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_range",
        F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_in_range").over(Window.partitionBy(*by)).alias("total"),
    )
    # Without groups there is one offset per range, a number bounded by configuration.
    side = offsets if by else F.broadcast(offsets)
    inside = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ladder = laid_out.join(side, [*by, "_range"]).select(
        *by,
        value,
        "n",
        (F.col("_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("below"),
        "total",
    )
    return Ladder(ladder, size["rungs"], size["rows"])


def ladder_pctile() -> Column:
    """Percentile rank of a ladder value: ties share their average rank, divided by the row count."""
    return (F.col("below") + (F.col("n") + 1) / 2) / F.col("total")


def ladder_position() -> Column:
    """Competition rank of a ladder value, 1 for the largest."""
    return F.col("total") - F.col("below") - F.col("n") + 1


def attach_ladder(df: DataFrame, ladder: Ladder, on: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Left join of values computed from the ladder to the rows.

    A short ladder is broadcast, its rungs having been counted.  Otherwise the
    values that hold more than a thousandth of all rows (fewer than a thousand
    values can) are looked up by broadcast, and their rows are spread over salts
    in the shuffle join that serves all other values.
    """
    on, names = list(on), list(columns)
    if ladder.rungs <= BROADCAST_ROW_LIMIT:
        side = ladder.df.select(*on, *[c.alias(n) for n, c in columns.items()])
        return df.join(F.broadcast(side), on, "left")
    is_heavy = F.col("n") * HEAVY_VALUE_LIMIT > F.lit(ladder.rows)
    heavy = ladder.df.filter(is_heavy).select(*on, *[c.alias(f"_heavy_{n}") for n, c in columns.items()])
    light = ladder.df.filter(~is_heavy).select(*on, F.lit(0).alias("_salt"), *[c.alias(n) for n, c in columns.items()])
    marked = df.join(F.broadcast(heavy), on, "left")
    found = F.col(f"_heavy_{names[0]}").isNotNull()
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int") + 1
    salted = marked.withColumn("_salt", F.when(found, spread).otherwise(F.lit(0)))
    joined = salted.join(light, [*on, "_salt"], "left")
    return joined.select(*df.columns, *[F.coalesce(F.col(f"_heavy_{n}"), F.col(n)).alias(n) for n in names])


def percentile_ranks(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add percentile ranks (average rank of ties over the row count; NULL for NULL).

    ``columns`` maps value columns to output names.  All of them share one
    ladder, keyed by the column's name.  ``df`` must give the same values on
    every read; pass derived floating-point values through ``materialise``.
    """
    entries = F.array(*[
        F.struct(F.lit(c).alias("_metric"), F.col(c).cast("double").alias("_value")) for c in columns
    ])
    ladder = value_ladder(df.select(F.inline(entries)), "_value", ["_metric"])
    out = df
    for source, target in columns.items():
        own = Ladder(ladder.df.filter(F.col("_metric") == source), ladder.rungs, ladder.rows)
        keyed = out.withColumn("_value", F.col(source).cast("double"))
        out = attach_ladder(keyed, own, ["_value"], {target: ladder_pctile()}).drop("_value")
    return out


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles with linear interpolation, one row per group and probability.

    The two neighbours of a quantile are the rungs that cover its position.
    """
    ladder = value_ladder(df.withColumn(value, F.col(value).cast("double")), value, by).df
    points = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    position = F.col("probability") * (F.col("total") - 1)
    last = F.col("below") + F.col("n") - 1
    # Only rungs next to a wanted position leave the scan of the ladder.
    near = ladder.withColumn("probability", points).withColumns({
        "_low": F.floor(position), "_high": F.ceil(position), "_part": position - F.floor(position)
    })

    def covers(target: str) -> Column:
        return F.col(target).between(F.col("below"), last)

    return (
        near.filter(covers("_low") | covers("_high"))
        .groupBy(*by, "probability")
        .agg(
            F.max(F.when(covers("_low"), F.col(value))).alias("_a"),
            F.max(F.when(covers("_high"), F.col(value))).alias("_b"),
            F.max("_part").alias("_part"),
        )
        .select(*by, "probability", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("quantile"))
    )


def z_scores(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add standard scores with the sample deviation; 0 for a constant column.

    The column means and deviations come back to the driver as one row and enter
    the plan as constants, so that every later pass sees the same scores.
    """
    row = df.agg(*[
        f(F.col(c).cast("double")).alias(f"{name}_{i}")
        for i, c in enumerate(columns)
        for name, f in (("m", F.avg), ("s", F.stddev_samp))
    ]).first()
    scored = {}
    for i, c in enumerate(columns):
        mean, sd = row[f"m_{i}"], row[f"s_{i}"]
        if sd is None:
            value = F.lit(None).cast("double")
        elif sd == 0:
            value = F.lit(0.0)
        else:
            value = (F.col(c) - F.lit(mean)) / F.lit(sd)
        scored[f"{c}{suffix}"] = value
    return df.withColumns(scored)
