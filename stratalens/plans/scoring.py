"""Scores of every timepoint, by ordinal mean or by level weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import with_moments
from ..operators.counts import derived_total_parts, long_to_wide
from ..operators.moments import weighted_parts, with_shares
from ..operators.pca import LevelWeights, derive_weights
from ..operators.validity import MIN_ASSESSED, MIN_GROUPS, finish_validity, validity_aggregates
from ..scales import Instrument

SCORING = ("pca", "ordinal")
MOMENT_SCORES = {
    "perf": "ordinal_mean",
    "sd": "ordinal_sd",
    "skew": "ordinal_skew",
    "kurt": "ordinal_kurt",
    "bc": "bimodality_coef",
}


def score_timepoints(
    counts: DataFrame,
    instrument: Instrument,
    keys: Sequence[str],
    scoring: str = "pca",
    weights: Sequence[float] | None = None,
    reference: Column | None = None,
    invert: bool = False,
    min_groups: int = MIN_GROUPS,
    min_assessed: int = MIN_ASSESSED,
) -> DataFrame:
    """Scores, validity flags and derived total per entity and timepoint, in one aggregation.

    ``perf`` (and ``sd``, ``skew``, ``kurt``, ``bc`` with ordinal scoring) are
    NULL where not valid.  Weighted scoring needs ``weights`` or the
    ``reference`` timepoint (a predicate) to derive them from: equal weights
    give every entity the same score.
    """
    if scoring not in SCORING:
        raise ValueError(f"scoring must be one of {SCORING}, not {scoring!r}")
    size = instrument.scale.size
    sums, total = derived_total_parts(size, instrument.language_chains)
    common = [*validity_aggregates(instrument.groups, size, "any", instrument.null_as_zero), *sums]
    shares = with_shares(counts, size, instrument.null_as_zero)
    if scoring == "ordinal":
        moments = with_moments(shares, size, zero_sd=instrument.zero_sd)
        table = moments.groupBy(*keys).agg(*common, *[F.avg(c).alias(n) for n, c in MOMENT_SCORES.items()])
        scores = {n: F.col(n) for n in MOMENT_SCORES}
    else:
        if weights is None:
            if reference is None:
                raise ValueError("weighted scoring needs weights or a reference timepoint")
            weights = weights_at(counts.filter(reference), instrument, keys, invert).weights
        weighted, weight = weighted_parts(weights)
        table = shares.groupBy(*keys).agg(*common, F.sum(weighted).alias("_weighted"), F.sum(weight).alias("_weight"))
        scores = {"perf": F.try_divide("_weighted", "_weight")}
    table = finish_validity(table, instrument.groups, min_groups, min_assessed)
    table = table.withColumns({
        "derived_total": total, **{n: F.when(F.col("valid"), c) for n, c in scores.items()}
    })
    return table.drop(*[c for c in table.columns if c.startswith("_")])


def weights_at(
    counts: DataFrame, instrument: Instrument, keys: Sequence[str], invert: bool = False, legacy_positional: bool = False
) -> LevelWeights:
    """Level weights from the counts of one timepoint."""
    shares = with_shares(counts, instrument.scale.size, instrument.null_as_zero)
    wide = long_to_wide(shares, keys, instrument.groups, instrument.scale, values="shares")
    return derive_weights(wide, instrument.groups, instrument.scale, invert, legacy_positional)
