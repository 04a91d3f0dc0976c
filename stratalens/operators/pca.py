"""Level weights from the first principal component of the percentage columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scales import Group, Scale

MIN_ROWS = 5


@dataclass(frozen=True)
class LevelWeights:
    weights: tuple[int, ...]
    loadings: tuple[float, ...]
    explained: float
    rows: int


def gramian(rows: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, sums and products of the columns over all rows, none of which may be NULL.

    A task adds up its rows batch by batch and gives one number per pair of columns, so what is shuffled and what the
    driver holds depends on the columns only.
    """
    size = len(columns)
    kind = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])
    i, j = np.triu_indices(size + 1)

    def add(batches):
        # The first column is one everywhere: its products are the number of rows and the sums.
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            x = np.column_stack([np.ones(len(batch)), *(c.to_numpy(zero_copy_only=False) for c in batch.columns)])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], schema=kind)

    parts = rows.select(*[F.col(f"`{c}`").cast("double") for c in columns]).mapInArrow(add, "i int, j int, value double")
    whole = np.zeros((size + 1, size + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        whole[r.i, r.j] = whole[r.j, r.i] = r.value
    return int(whole[0, 0]), whole[0, 1:], whole[1:, 1:]


def first_component(n: int, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, float]:
    """Loadings of the first principal component of the standardised columns, and its share of the variance.

    A column that never changes has no part in it.
    """
    covariance = (products - np.outer(sums, sums) / n) / (n - 1)
    deviation = np.sqrt(np.clip(np.diag(covariance), 0.0, None))
    moving = deviation > 1e-9 * (1 + np.abs(sums / n))
    scale = np.where(moving, deviation, np.inf)
    correlation = covariance / np.outer(scale, scale)
    values, vectors = np.linalg.eigh(correlation)
    return vectors[:, -1], float(values[-1] / np.trace(correlation)) if moving.any() else float("nan")


def derive_weights(
    wide: DataFrame, groups: Sequence[Group], scale: Scale, invert: bool = False, legacy_positional: bool = False
) -> LevelWeights:
    """Weights 0 to 100 per level from the rows that have every percentage column.

    Products of the columns are added up in one pass, see ``gramian``.  Loadings are
    averaged per level.  The sign is fixed so that the best level loads
    positively.  ``legacy_positional`` averages consecutive slices of the
    group-by-group column order instead, as older published weights did.
    ``invert`` flips all levels but the best when the middle level loads lower
    than the worst.
    """
    columns = [f"{g.label} {level}" for g in groups for level in scale.levels]
    rows, sums, products = gramian(wide.select(*[f"`{c}`" for c in columns]).dropna(), columns)
    if rows < MIN_ROWS:
        raise ValueError(f"only {rows} complete rows; at least {MIN_ROWS} are needed")
    component, explained = first_component(rows, sums, products)
    loadings = [float(x) for x in component]
    k, n = scale.size, len(groups)
    if legacy_positional:
        by_level = [sum(loadings[i * n:(i + 1) * n]) / n for i in range(k)]
    else:
        by_level = [sum(loadings[i::k]) / n for i in range(k)]
    if by_level[-1] < 0:
        by_level = [-x for x in by_level]
    middle = k // 2
    if invert and by_level[middle] < by_level[0]:
        by_level = [-x for x in by_level[:-1]] + by_level[-1:]
    low, high = min(by_level), max(by_level)
    weights = tuple(round(100 * (x - low) / (high - low)) for x in by_level)
    return LevelWeights(weights, tuple(by_level), explained, rows)
