"""Mixing sources to target weights, in DataFrame functions only.

``targets`` adds up tokens per source and fills ``share`` times the total into the sources
by weight.  A source takes at most ``most`` times its own size; what it cannot take goes to
the others by weight, until no source is above.  Each round is one aggregation over the
table of sources and only lifts the level, so a source once full stays full.

``draw`` turns a target into a repetition rate and gives each document floor(rate) copies,
and one more with the probability of the rest, decided by a hash of seed and document.
``emit`` repeats the rows.

Defined results: NULL text has size 0.  NULL is a source of its own and comes last.  Sources
without tokens have target 0 and rate 0.  The draw depends on the document id, or on the
text where the id is NULL, so repeated rows draw alike and reruns agree.  An empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .shared import fraction

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drawn_number(doc_id: Column, text: Column, seed: str) -> Column:
    """The document's number in [0, 1)."""
    return fraction(seed, F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary"))))


def targets(
    sizes: DataFrame,
    *,
    source_column: str = "source",
    size_column: str = "size",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """(source, source_size, weight, target) per source; weights repeat over the sources in code-point order.

    Places are counted over ranges of the sorted sources, so no task holds them all.
    """
    ordered = (
        sizes.groupBy(F.col(source_column).alias("source"))
        .agg(F.sum(size_column).alias("source_size"))
        .orderBy(F.col("source").asc_nulls_last())
        .withColumn("place", F.monotonically_increasing_id())
    )
    ordered = materialise(ordered)
    part = F.shiftright("place", 33)
    # One row per range of sources.
    parts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset")
    )
    place = F.col("offset") + F.col("place").bitwiseAND((1 << 33) - 1)
    sources = materialise(
        ordered.join(parts, part == F.col("part"))
        .withColumn("weight", F.get(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int")))
        .select("source", "source_size", "weight", (F.col("source_size") * F.lit(float(most))).alias("cap"))
    )
    full, rest, open_weight, count = F.lit(False), 0.0, 1.0, -1
    while True:
        total = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("cap"))).alias("filled"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if total.n == count:
            break
        count = total.n
        rest = share * (total["all"] or 0) - (total.filled or 0.0)
        open_weight = float(total.weight or 1)
        full = F.col("weight") * F.lit(rest) > F.col("cap") * F.lit(open_weight)
    level = F.lit(rest) * F.col("weight") / F.lit(open_weight)
    return sources.select("source", "source_size", "weight", F.when(full, F.col("cap")).otherwise(level).alias("target"))


def draw(
    docs: DataFrame,
    source_targets: DataFrame,
    drawn: Column,
    *,
    source_column: str = "source",
    into: str = "mix",
) -> DataFrame:
    """Add ``into``: struct(source_size, target, copies).  ``drawn`` is each document's number in [0, 1)."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    priced = source_targets.select(
        F.col("source").alias("__priced_source"),
        F.struct("source_size", "target", rate.alias("rate")).alias("__priced"),
    )
    copies = F.floor("__priced.rate") + (drawn < F.col("__priced.rate") - F.floor("__priced.rate")).cast("long")
    joined = docs.join(priced, docs[source_column].eqNullSafe(F.col("__priced_source")))
    return joined.withColumn(
        into, F.struct(F.col("__priced.source_size").alias("source_size"), F.col("__priced.target").alias("target"), copies.alias("copies"))
    ).drop("__priced_source", "__priced")


def emit(docs: DataFrame, *, into: str = "mix") -> DataFrame:
    """Repeat each row as often as it was drawn, without the column of the draw."""
    copies = F.col(f"{into}.copies")
    repeated = docs.where(copies > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return repeated.drop("__copy", into)
