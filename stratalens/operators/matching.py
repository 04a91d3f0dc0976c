"""Match area names of a fund table to the areas of a crosswalk, exactly first, then by similarity."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import edit_ratio, place_name, region_short
from ..session import materialise
from .keysets import keep_first
from .nearest import nearest_names

AREA_TYPES = ("City", "Municipality")
SCOPES = ("region+province", "province_only", "region_only")
TARGET = ("region_norm", "province_norm", "name_norm")


def normalised(df: DataFrame, region: str, province: str, name: str, name_out: str = "name_norm") -> DataFrame:
    """Add comparable forms of region, province and name."""
    return df.withColumns({
        "region_norm": region_short(F.col(region)),
        "province_norm": place_name(F.col(province)),
        name_out: place_name(F.col(name)),
    })


def area_candidates(crosswalk: DataFrame) -> DataFrame:
    """One row per distinct (region, province, name) of the crosswalk, lowest code first."""
    columns = crosswalk.select(*TARGET, "area_code", "area_name")
    return keep_first(columns, TARGET, [F.col("area_code"), F.col("area_name")])


def _unique(candidates: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Candidates that are alone under their keys."""
    return candidates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("area_code").alias(f"{prefix}_code"),
        F.min("area_name").alias(f"{prefix}_name"),
    ).filter(F.col("_n") == 1).drop("_n")


def exact_matches(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """Add code, name and tier of the first exact rule that finds a single candidate.

    Rules: region, province and name; province and name; a city that is its own
    province, or else a name that exists once.  Each rule is a left join to a
    table with unique keys, so no rule can multiply targets.
    """
    own_city = candidates.filter(F.col("province_norm") == F.col("name_norm"))
    tiers = {
        "exact": (_unique(candidates, TARGET, "t1"), list(TARGET)),
        "exact_cross_region": (_unique(candidates, TARGET[1:], "t2"), list(TARGET[1:])),
        "_city": (_unique(own_city, TARGET[2:], "t3"), list(TARGET[2:])),
        "_name": (_unique(candidates, TARGET[2:], "t4"), list(TARGET[2:])),
    }
    out = targets
    for table, keys in tiers.values():
        out = out.join(table, keys, "left")
    found = [F.col(f"t{i}_code").isNotNull() for i in (1, 2, 3, 4)]
    kind = (
        F.when(found[0], "exact")
        .when(found[1], "exact_cross_region")
        .when(found[2] | found[3], "independent_city")
    )
    return out.select(
        *targets.columns,
        F.coalesce(*[F.col(f"t{i}_code") for i in (1, 2, 3, 4)]).alias("exact_code"),
        F.coalesce(*[F.col(f"t{i}_name") for i in (1, 2, 3, 4)]).alias("exact_name"),
        kind.alias("exact_kind"),
    )


@F.pandas_udf(DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of two names: twice the matched characters over all characters."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def bigrams(name: Column) -> Column:
    """Distinct pairs of neighbouring characters, with the ends of the name marked."""
    marked = F.concat(F.lit("^"), name, F.lit("$"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substr(marked, i, F.lit(2))
    )
    return F.array_distinct(pairs)


def _ratio(similarity: str) -> Column:
    return edit_ratio(F.col("_target"), F.col("_name")) if similarity == "edit" else block_ratio("_target", "_name")


def _best(met: DataFrame, scope: Sequence[str], similarity: str, least: float) -> DataFrame:
    """The most similar candidate of every (scope, ``_target``) at or above ``least``; ties go to the lower name, then code.

    The same two names meet in many scopes; they are compared once.
    """
    lengths = [F.length("_target"), F.length("_name")]
    bound = F.least(*lengths) / F.greatest(*lengths) if similarity == "edit" else 2 * F.least(*lengths) / (lengths[0] + lengths[1])
    near = met.where(bound >= least)
    ratios = near.select("_target", "_name").distinct().withColumn("_ratio", _ratio(similarity)).where(F.col("_ratio") >= least)
    rank = F.struct(
        (-F.col("_ratio")).alias("order"),
        F.col("_name").alias("name"),
        F.col("_area.area_code").alias("code"),
        F.col("_area.area_name").alias("label"),
    )
    return near.join(ratios, ["_target", "_name"]).groupBy(*scope, F.col("_target").alias("name_norm")).agg(F.min(rank).alias("_found"))


def _names(targets: DataFrame, candidates: DataFrame, scope: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct names per scope of both sides, so that a name used in many places is one row."""
    left = targets.select(*scope, F.col("name_norm").alias("_target")).distinct()
    right = candidates.groupBy(*scope, F.col("name_norm").alias("_name")).agg(F.min(F.struct("area_code", "area_name")).alias("_area"))
    return left, right


def best_match(targets: DataFrame, candidates: DataFrame, scope: Sequence[str], similarity: str, threshold: float) -> DataFrame:
    """The most similar candidate of every target name inside a scope, if it reaches ``threshold``.

    Candidates meet targets in an equi-join on scope and character pair; Spark splits pairs
    that are frequent.
    """
    left, right = _names(targets, candidates, scope)
    pair = lambda c: F.explode(bigrams(F.col(c))).alias("_pair")
    met = left.select("*", pair("_target")).join(right.select("*", pair("_name")), [*scope, "_pair"]).drop("_pair").distinct()
    return _best(met, scope, similarity, threshold)


def near_misses(targets: DataFrame, candidates: DataFrame, similarity: str) -> DataFrame:
    """The nearest name of the region for names without a match, whatever they share."""
    left, right = _names(targets, candidates, TARGET[:1])
    ratio = edit_ratio if similarity == "edit" else block_ratio
    found, _ = nearest_names(left, right, TARGET[:1], ratio, similarity)
    return found.withColumnRenamed("_target", "name_norm")


def fuzzy_matches(
    targets: DataFrame, candidates: DataFrame, threshold: float = 0.80, similarity: str = "edit"
) -> DataFrame:
    """Best candidate per target: within region and province, else the province, else the region.

    The first scope whose best candidate reaches ``threshold`` counts, and later scopes
    see only targets that are still open.  A target without any keeps the nearest name of its region as a
    near miss.  Ties go to the lower name, then code.

    For matches only names that share a pair of neighbouring characters are compared.  That
    loses none: of the marked pairs of a name, one edit breaks at most two,
    so with a ratio of at least one half by edits (four fifths by blocks) one
    survives.
    """
    floor = {"edit": 0.5, "blocks": 0.8}
    if similarity not in floor:
        raise ValueError(f"unknown similarity {similarity!r}")
    if threshold < floor[similarity]:
        raise ValueError(f"threshold must be at least {floor[similarity]}")
    still_open, parts = targets.select(*TARGET), []
    chosen = [F.col("_found.code").alias("fuzzy_code"), F.col("_found.label").alias("fuzzy_name"), (-F.col("_found.order")).alias("fuzzy_ratio")]
    for label, scope in zip(SCOPES, (TARGET[:2], TARGET[1:2], TARGET[:1])):
        best = best_match(still_open, candidates, scope, similarity, threshold)
        tried = materialise(still_open.join(best, [*scope, "name_norm"], "left"))
        parts.append(tried.where("_found IS NOT NULL").select(*TARGET, F.lit(f"fuzzy_{label}").alias("fuzzy_kind"), *chosen))
        still_open = tried.where("_found IS NULL").select(*TARGET)
    nearest = near_misses(still_open, candidates, similarity)
    missed = still_open.join(nearest, [TARGET[0], "name_norm"], "left")
    out = missed.select(*TARGET, F.lit("unmatched").alias("fuzzy_kind"), *chosen)
    for part in parts:
        out = out.unionByName(part)
    return out


def match_areas(
    funds: DataFrame, crosswalk: DataFrame, threshold: float = 0.80, similarity: str = "edit"
) -> DataFrame:
    """The fund table's cities and municipalities with code, match type and similarity.

    ``funds`` has ``region``, ``province``, ``area`` and ``area_type``;
    ``crosswalk`` has the normalised names, ``area_code`` and ``area_name``.
    Unmatched rows keep a NULL code and their near miss.
    """
    rows = normalised(funds.filter(F.col("area_type").isin(*AREA_TYPES)), "region", "province", "area")
    # Both are name lists that several joins below read again.
    candidates = materialise(area_candidates(crosswalk))
    exact = materialise(exact_matches(rows.select(*TARGET).distinct(), candidates))
    open_targets = exact.filter(F.col("exact_code").isNull()).select(*TARGET)
    fuzzy = fuzzy_matches(open_targets, candidates, threshold, similarity)
    known = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in TARGET]
    keyed = exact.join(
        fuzzy.withColumnsRenamed({c: f"_k_{c}" for c in TARGET}), on=known[0] & known[1] & known[2], how="left"
    )
    is_exact = F.col("exact_code").isNotNull()
    kind = F.coalesce(F.col("exact_kind"), F.col("fuzzy_kind"), F.lit("unmatched"))
    table = keyed.select(
        *[F.col(c).alias(f"_m_{c}") for c in TARGET],
        kind.alias("match_type"),
        F.coalesce(F.col("exact_name"), F.col("fuzzy_name"), F.lit("")).alias("matched_to"),
        F.when(is_exact, F.col("exact_code")).when(kind != "unmatched", F.col("fuzzy_code")).alias("area_code"),
        F.when(is_exact, 1.0).otherwise(F.coalesce(F.col("fuzzy_ratio"), F.lit(0.0))).alias("similarity"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in TARGET]
    return rows.join(table, on=same[0] & same[1] & same[2], how="left").drop(*[f"_m_{c}" for c in TARGET])


def matched(log: DataFrame) -> DataFrame:
    """Rows with an area code."""
    return log.filter(F.col("area_code").isNotNull())


def unmatched(log: DataFrame) -> DataFrame:
    """Rows without one."""
    return log.filter(F.col("area_code").isNull())


def join_funds(crosswalk: DataFrame, matched_funds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fund columns for every entity of the crosswalk: by area code, else by province.

    Both fund tables are made unique first (by name), so that an entity keeps
    exactly one row.  The province serves only entities without a code match.
    """
    wanted = ["area", "area_type", *columns]
    order = [F.col("area"), F.col("area_type")]
    by_code = keep_first(matched_funds.select("area_code", *wanted), ["area_code"], order)
    by_province = keep_first(matched_funds.select("province_norm", *wanted), ["province_norm"], order)
    out = crosswalk.join(
        by_code.withColumnsRenamed({c: f"_c_{c}" for c in wanted}), "area_code", "left"
    ).join(by_province.withColumnsRenamed({c: f"_p_{c}" for c in wanted}), "province_norm", "left")
    coded = F.col("_c_area").isNotNull()
    return out.select(
        *crosswalk.columns,
        *[F.when(coded, F.col(f"_c_{c}")).otherwise(F.col(f"_p_{c}")).alias(f"fund_{c}") for c in wanted],
    )
