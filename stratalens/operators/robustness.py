"""How far a ranking depends on its weights and cutoffs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .ranks import attach_ladder, ladder_pctile, ladder_position, percentile_ranks, value_ladder

KENDALL_CHUNK = 100_000


def random_weights(base: Mapping[str, float], draws: int, seed: int = 42, low=0.5, high=1.5) -> list[dict[str, float]]:
    """Weightings around ``base``: every weight times a uniform factor, from a seed."""
    factors = np.random.default_rng(seed).uniform(low, high, size=(draws, len(base)))
    return [
        {name: round(float(weight * f), 6) for (name, weight), f in zip(base.items(), row, strict=True)}
        for row in factors
    ]


def ranks_by_draw(
    scored: DataFrame, entity: str, draws: Sequence[Mapping[str, float]], digits: int = 9
) -> DataFrame:
    """Priority position of every entity under every weighting.

    ``scored`` has the standardised components ``z_<name>`` and the percentile
    ranks of the other two pillars.  Each entity becomes one row per weighting
    by an explode; both rankings inside a weighting are ladders keyed by it.
    """
    names = list(draws[0])
    # One literal, however many draws: a JSON text that is folded when the plan is made.
    kind = ", ".join(["draw int", *(f"w_{n} double" for n in names)])
    told = json.dumps([{"draw": i} | {f"w_{n}": float(d[n]) for n in names} for i, d in enumerate(draws)])
    grid = F.from_json(F.lit(told), f"array<struct<{kind.replace(' ', ':')}>>".replace(",:", ","))
    rows = scored.select(
        entity, "impact_pctile", "capacity_gap_pctile", *[f"z_{n}" for n in names], F.inline(grid)
    )
    need = reduce(lambda a, b: a + b, [F.col(f"w_{n}") * F.col(f"z_{n}") for n in names])
    rows = rows.select(
        entity, "draw", "impact_pctile", "capacity_gap_pctile", F.round(need, digits).alias("need_score")
    )
    ranked = attach_ladder(rows, value_ladder(rows, "need_score", ["draw"]), ["draw", "need_score"], {
        "need_pctile": ladder_pctile()
    })
    products = materialise(ranked.select(
        entity, "draw",
        (F.col("need_pctile") * F.col("impact_pctile") * F.col("capacity_gap_pctile")).alias("priority_score"),
    ))
    return attach_ladder(
        products, value_ladder(products, "priority_score", ["draw"]), ["draw", "priority_score"],
        {"position": ladder_position()},
    ).select(entity, "draw", "position")


def rank_spread(by_draw: DataFrame, entity: str, top: int = 100) -> DataFrame:
    """Median, interquartile range, extremes and top-list share of each entity's positions.

    A group has one row per weighting, however many entities there are.
    """
    quartiles = F.percentile("position", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = by_draw.groupBy(entity).agg(
        quartiles.alias("_q"),
        F.min("position").alias("best"),
        F.max("position").alias("worst"),
        F.avg((F.col("position") <= top).cast("double")).alias("top_share"),
    )
    return out.select(
        entity,
        F.get("_q", F.lit(1)).alias("median_position"),
        (F.get("_q", F.lit(2)) - F.get("_q", F.lit(0))).alias("iqr"),
        "best",
        "worst",
        "top_share",
    )


def rank_correlations(df: DataFrame, target: str, others: Sequence[str]) -> DataFrame:
    """Spearman correlation of each column with ``target``, one row per column.

    The ranks of all columns come from one ladder.
    """
    ranked = percentile_ranks(df, {c: f"_r_{c}" for c in dict.fromkeys([target, *others])})
    row = ranked.agg(*[F.corr(f"_r_{target}", f"_r_{c}").alias(c) for c in others])
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("spearman")) for c in others])
    return row.select(F.inline(cells))


def cutoff_overlap(df: DataFrame, first: str, second: str, cutoffs: Sequence[int]) -> DataFrame:
    """Share of the top list under ``first`` that is also in the top list under ``second``, per cutoff.

    Positions come from one ladder; the overlaps from one aggregation.
    """
    ladder_input = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("_metric"), F.col(c).cast("double").alias("_value")) for c in (first, second)
    ])))
    ladder = value_ladder(ladder_input, "_value", ["_metric"])
    out = df.select(F.col(first).cast("double").alias("_first"), F.col(second).cast("double").alias("_second"))
    for side in ("_first", "_second"):
        metric = first if side == "_first" else second
        keyed = out.withColumns({"_metric": F.lit(metric), "_value": F.col(side)})
        out = attach_ladder(keyed, ladder, ["_metric", "_value"], {f"{side}_at": ladder_position()}).drop("_metric", "_value")
    cells = [
        F.struct(
            F.lit(c).alias("cutoff"),
            F.count_if((F.col("_first_at") <= c) & (F.col("_second_at") <= c)).alias("common"),
            F.count_if(F.col("_first_at") <= c).alias("listed"),
        )
        for c in cutoffs
    ]
    wide = out.agg(*[c.alias(f"_c{i}") for i, c in enumerate(cells)])
    return wide.select(F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(cells))]))).withColumn(
        "overlap", F.try_divide("common", "listed")
    )


def top_list_kendall(df: DataFrame, entity: str, first: str, second: str, n: int | None = None) -> DataFrame:
    """Kendall's tau-a of two scores; ties count as neither.  With ``n`` over the top list of the first, else over all.

    Concordant and discordant pairs are counted bit by bit.  Two different positions under
    the second score part at one bit, below a common prefix; so for every bit, rows with the same
    prefix are ordered by their position under the first score, and each counts the rows before it whose
    bit differs.  These counts are sums over chunks of positions and running counts inside a chunk, so the
    work is n log n and no task holds a whole list.  Rows of one position are counted first, so ties are one row.
    """
    pair = df.select(entity, F.col(first).cast("double").alias("_a"), F.col(second).cast("double").alias("_b"))
    if n is not None:
        pair = pair.orderBy(F.desc("_a"), F.asc(entity)).limit(n)
    pair = materialise(pair)
    for c in ("_a", "_b"):
        pair = attach_ladder(pair, value_ladder(pair, c), [c], {f"{c}_at": ladder_position()})
    placed = materialise(pair.where("_a_at IS NOT NULL AND _b_at IS NOT NULL").select("_a_at", "_b_at"))
    size = placed.count()
    bits = max(1, size.bit_length())
    keys, sums = ["_bit", "_prefix"], [F.sum(F.col("_n") * F.col("_high")).alias("_ones"), F.sum(F.col("_n") * (1 - F.col("_high"))).alias("_zeros")]
    spread = placed.groupBy("_a_at", "_b_at").agg(F.count("*").alias("_n")).withColumn("_bit", F.explode(F.sequence(F.lit(0), F.lit(bits - 1)))).select(
        "_bit",
        F.expr("shiftright(_b_at, _bit + 1)").alias("_prefix"),
        (F.expr("shiftright(_b_at, _bit)") % 2).alias("_high"),
        F.col("_a_at").alias("_at"),
        F.floor(F.col("_a_at") / KENDALL_CHUNK).alias("_chunk"),
        "_n",
    )
    cells = spread.groupBy(*keys, "_chunk", "_at").agg(*sums)
    chunks = cells.groupBy(*keys, "_chunk").agg(F.sum("_ones").alias("_ones"), F.sum("_zeros").alias("_zeros"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select(
        *keys, "_chunk",
        F.coalesce(F.sum("_ones").over(earlier), F.lit(0)).alias("_ones_before"),
        F.coalesce(F.sum("_zeros").over(earlier), F.lit(0)).alias("_zeros_before"),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counted = cells.select(
        *keys, "_chunk", "_ones", "_zeros",
        *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_inside") for c in ("_ones", "_zeros")),
    ).join(before, [*keys, "_chunk"])
    agree = F.col("_ones") * (F.col("_zeros_inside") + F.col("_zeros_before")) - F.col("_zeros") * (F.col("_ones_inside") + F.col("_ones_before"))
    # As a number with a point: Spark's product of two whole literals overflows from 46,342 rows on.
    return counted.agg(F.coalesce(F.sum(agree), F.lit(0)).alias("_sum")).select(
        F.lit(size).alias("entities"), F.try_divide(2.0 * F.col("_sum"), F.lit(float(size * (size - 1)))).alias("kendall")
    )
