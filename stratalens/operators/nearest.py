"""The nearest name of a scope for names without a match, by bounded search.

Comparing every name with every other of its scope would be quadratic in the largest scope.  Instead a few
first candidates set a bound for each target, and only names that can still reach it are fetched:

1. For every pair of neighbouring characters and every length, the lowest name of the scope that has both
   stands in for the rest.  A target meets those of its own pairs and of lengths next to its own.
2. A target that is still less than half alike to all of them meets one name of every cell; a cell is a length and a coarse bag of
   characters, so the number of cells depends on the lengths, not on the number of names.
3. With a ratio of one half or more, a name can only be as near if some of the rarest character runs
   of the target stand in it: an edit breaks at most q runs of length q, so of q times the allowed edits
   and m more runs, m survive.  Names are looked up by scope, length and m runs, two of 3 or 2 characters where the
   count allows it, else one.  A run that a name holds twice counts as two.  A first round asks for names of a ratio of
   ``NEAR`` or more, which few runs find; a second one, down to one half, serves the targets that found none.
4. Targets that are less than half alike to every name fetch the cells whose length and bag difference can still reach the bound.

Scopes with at most ``WHOLE_PAIRS`` pairs are compared whole, which bounds the work per name and saves the search's jobs;
the search serves larger ones.  The result is the same as over all pairs.  Ties go to the lower name, then code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import edit_ratio
from ..session import materialise

# Length of runs, and how many of them a name must share with the target; the first that the lengths allow is taken.
KEYS = ((3, 2), (2, 2), (2, 1))
BAGS = 3
HALF, NEAR = 0.5, 0.7
# A ratio of two lengths may differ from the quotient it stands for in its last digit.
SLACK = 1e-9
WHOLE_PAIRS = 1_000_000


def runs_of(name: Column, length: int) -> Column:
    """Distinct runs of so many characters, with the ends of the name marked."""
    marked = F.concat(F.lit("^" * (length - 1)), name, F.lit("$" * (length - 1)))
    pieces = F.transform(F.sequence(F.lit(1), F.length(name) + length - 1), lambda i: F.substr(marked, i, F.lit(length)))
    return F.when(F.length(name) > 0, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def numbered_runs(name: Column, length: int) -> Column:
    """All runs of so many characters, each with the number of equal ones before it."""
    marked = F.concat(F.lit("^" * (length - 1)), name, F.lit("$" * (length - 1)))
    runs = F.transform(F.sequence(F.lit(1), F.length(name) + length - 1), lambda i: F.substr(marked, i, F.lit(length)))
    number = lambda x, i: F.size(F.filter(F.slice(runs, F.lit(1), i), lambda y: y == x))
    return F.array_sort(F.transform(runs, lambda x, i: F.concat(x, F.lit("\u0001"), number(x, i).cast("string"))))


def pairs_of(tokens: Column) -> Column:
    """Every two of a sorted array, joined."""
    rest = lambda i: F.slice(tokens, i + 2, F.size(tokens))
    return F.flatten(F.transform(tokens, lambda x, i: F.transform(rest(i), lambda y: F.concat(x, F.lit("\u0002"), y))))


def bag(name: Column) -> Column:
    """How many characters fall into each of ``BAGS`` classes of code points; the bags of two names differ by no more than the names."""
    classes = F.transform(F.filter(F.split(name, ""), lambda c: c != ""), lambda c: F.ascii(c) % BAGS)
    count = lambda wanted: F.size(F.filter(classes, lambda c: c == wanted))
    return F.array(*map(count, range(BAGS)))


def allowed_edits(length: Column, other: Column, ratio: Column) -> Column:
    """The most edits between names of these lengths whose edit ratio is not below ``ratio``."""
    return F.floor(F.greatest(length, other) * (1 - ratio) + SLACK).cast("int")


def _may_reach(similarity: str) -> Column:
    """Whether a name of cell (``length``, ``bag``) can have the ratio ``_bound`` with a target."""
    size = F.length("_target")
    over = F.zip_with("_bag", "bag", lambda a, b: F.greatest(a - b, F.lit(0)))
    more = F.aggregate(over, F.lit(0), lambda total, x: total + x)
    less = F.col("length") - size + more
    if similarity == "edit":
        return F.greatest(more, less) <= allowed_edits(size, F.col("length"), F.col("_bound"))
    return 2 * (size - more) >= F.col("_bound") * (size + F.col("length")) - SLACK


def _better(*parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The best of what several searches found for each target."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*keys, "_target").agg(F.min("_found").alias("_found"))


def nearest_names(
    targets: DataFrame, names: DataFrame, scope: Sequence[str], ratio: Callable[[Column, Column], Column] = edit_ratio, similarity: str = "edit",
    whole_pairs: int = WHOLE_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """(scope, _target, _found) for distinct names (scope, _target), and the pairs the last search compared.

    ``names`` has (scope, _name, _area) with a struct (area_code, area_name); a scope without names finds nothing.
    ``similarity`` says which bounds hold for ``ratio``: ``edit``, or ``blocks`` for twice the matched characters over all.
    NULL scopes find nothing; an empty name is as far from all others as can be.
    """
    scope = list(scope)
    found = F.struct(
        (-F.col("_ratio")).alias("order"), F.col("_name").alias("name"), F.col("_area.area_code").alias("code"), F.col("_area.area_name").alias("label")
    )

    def compared(met: DataFrame) -> DataFrame:
        # The same two names meet in many scopes; they are compared once.
        ratios = met.select("_target", "_name").distinct().withColumn("_ratio", ratio(F.col("_target"), F.col("_name")))
        return met.select(*scope, "_target", "_name", "_area").join(ratios, ["_target", "_name"]).groupBy(*scope, "_target").agg(F.min(found).alias("_found"))

    def bounded(best: DataFrame) -> DataFrame:
        return best.withColumn("_bound", -F.col("_found.order"))

    names = materialise(names.withColumns({"length": F.length("_name"), "bag": bag(F.col("_name"))}))
    targets = materialise(targets.select(*scope, "_target").distinct())
    held = [df.groupBy(*scope).agg(F.count("*").alias(n)) for df, n in ((targets, "asked"), (names, "offered"))]
    sizes = materialise(held[0].join(held[1], scope))
    small = F.col("asked") * F.col("offered") <= whole_pairs
    few = targets.join(sizes.where(small).select(*scope), scope, "left_semi").join(names, scope).select(*scope, "_target", "_name", "_area")
    large = sizes.where(~small).select(*scope)
    if large.isEmpty():
        return compared(few), few
    targets = materialise(targets.join(large, scope, "left_semi"))
    stand_in = F.min(F.struct("_name", "_area")).alias("stand_in")
    opened = lambda df: df.select("*", "stand_in.*").drop("stand_in")

    # 1. One name per pair and length, and the lowest of all.
    pairs = names.select(*scope, "length", "_name", "_area", F.explode(runs_of(F.col("_name"), 2)).alias("run"))
    pairs = opened(pairs.groupBy(*scope, "length", "run").agg(stand_in))
    lowest = opened(names.groupBy(*scope).agg(stand_in))
    size = F.length("_target")
    asked = targets.select(*scope, "_target", F.explode(runs_of(F.col("_target"), 2)).alias("run"))
    asked = asked.withColumn("length", F.explode(F.array(size - 1, size, size + 1)))
    met = asked.join(pairs, [*scope, "length", "run"]).select(*scope, "_target", "_name", "_area")
    met = met.unionByName(targets.join(lowest, scope).select(*scope, "_target", "_name", "_area"))
    first = materialise(bounded(compared(met.distinct())))

    # 2. One name per cell, for targets far from all so far.
    cells = materialise(opened(names.groupBy(*scope, "length", "bag").agg(stand_in)))
    far = first.where(F.col("_bound") < HALF).withColumn("_bag", bag(F.col("_target")))
    tried = far.join(cells, scope).where(_may_reach(similarity)).select(*scope, "_target", "_name", "_area")
    second = materialise(bounded(_better(first.drop("_bound"), compared(tried), keys=scope)))

    compared_pairs, best = [], second
    if similarity == "edit":
        # 3. Rare runs: first for names that are nearly as near as can be, then for all that share enough.
        search = _RunSearch(names, scope)
        for least in (NEAR, HALF):
            # With a bound of ``NEAR`` or more after the first round, nothing nearer is left.
            wanted = best if least == NEAR else best.where(F.col("_bound") < NEAR)
            pairs = materialise(search.pairs(wanted.withColumn("_bound", F.greatest(F.col("_bound"), F.lit(least)))))
            compared_pairs.append(pairs)
            best = materialise(bounded(_better(best.drop("_bound"), compared(pairs), keys=scope)))
    # 4. Whole cells, where no run need be shared.
    far = best.where(F.col("_bound") < HALF) if similarity == "edit" else best
    reached = far.withColumn("_bag", bag(F.col("_target"))).join(cells.select(*scope, "length", "bag"), scope).where(_may_reach(similarity))
    pairs = reached.select(*scope, "_target", "length", "bag").join(names, [*scope, "length", "bag"]).select(*scope, "_target", "_name", "_area")
    compared_pairs.append(materialise(pairs))
    result = _better(best.drop("_bound"), compared(compared_pairs[-1]), keys=scope)
    return result.unionByName(compared(few)), reduce(DataFrame.unionByName, compared_pairs, few)


class _RunSearch:
    """Names by scope, length and the runs they hold."""

    def __init__(self, names: DataFrame, scope: list[str]):
        name = F.col("_name")
        runs = {length: numbered_runs(name, length) for length, _ in KEYS}
        every = F.concat(*(runs[length] if shared == 1 else pairs_of(runs[length]) for length, shared in KEYS))
        named = names.where("length > 0")
        self.scope = scope
        self.listed = materialise(named.select(*scope, "length", "_name", "_area", F.explode(every).alias("key")))
        held = named.select(*scope, "length", F.explode(F.concat(*runs.values())).alias("run"))
        self.counts = materialise(held.groupBy(*scope, "length", "run").agg(F.count("*").alias("names")))

    def pairs(self, targets: DataFrame) -> DataFrame:
        """(scope, _target, _name, _area) of all names that can have the edit ratio ``_bound``, one half or more, with a target."""
        scope, size, length = self.scope, F.length("_target"), F.col("length")
        lengths = F.sequence(F.ceil(size * F.col("_bound") - SLACK).cast("int"), F.floor(size / F.col("_bound") + SLACK).cast("int"))
        near = targets.where(size > 0).select(*scope, "_target", "_bound", F.explode(lengths).alias("length"))
        edits = allowed_edits(size, length, F.col("_bound"))

        def option(run: int, shared: int) -> Column:
            needed = run * edits - F.greatest(length - size, F.lit(0)) + shared
            told = F.struct(F.lit(shared).alias("shared"), needed.alias("needed"), numbered_runs(F.col("_target"), run).alias("runs"))
            return F.when(needed <= size + run - 1, told)

        near = near.withColumn("_chosen", F.coalesce(*(option(*k) for k in KEYS)))
        near = near.select(*scope, "_target", "length", "_chosen.shared", "_chosen.needed", F.explode("_chosen.runs").alias("run"))
        rarest = Window.partitionBy(*scope, "_target", "length").orderBy(F.coalesce("names", F.lit(0)), "run")
        asked = near.join(self.counts, [*scope, "length", "run"], "left").withColumn("_rank", F.row_number().over(rarest))
        # Runs that no name has take their place among the rarest, but nothing can be found by them.
        asked = asked.where((F.col("_rank") <= F.col("needed")) & F.col("names").isNotNull())
        kept = asked.groupBy(*scope, "_target", "length", "shared").agg(F.array_sort(F.collect_list("run")).alias("runs"))
        keys = F.when(F.col("shared") == 1, F.col("runs")).otherwise(pairs_of(F.col("runs")))
        asked = kept.select(*scope, "_target", "length", F.explode(keys).alias("key"))
        return asked.join(self.listed, [*scope, "length", "key"]).select(*scope, "_target", "_name", "_area").distinct()
