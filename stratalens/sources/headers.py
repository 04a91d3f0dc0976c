"""Header rules: from the first line of an export to (position, canonical name) pairs.

They work on the header alone, before Spark names any column: Spark renames all
columns that share a name, ignoring case, so duplicates must be resolved by
position.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..scales import (
    EARLY_READING,
    KEY_STAGE_GRADES,
    LANGUAGES,
    MATH_5,
    METADATA,
    READING_3,
    READING_7,
    Group,
)

KEY = "School ID"
Header = list[tuple[int, str]]

# Misspelt and misplaced header texts.
LANGUAGE_TYPO = ("FIl", "Fil")
WRONG_ENROLLED = ("Total Enrolled (G4-G6)", "Total Enrolled (G7-G10)")
REVERSED_LEVEL = re.compile(r"^(G\d+)\s+(Fil|Eng)\s+(Frustration|Instructional|Independent)\s+(\d)Level$")
COPY_SUFFIX = re.compile(r"\.\d+$")


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of an export."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return next(csv.reader([first[0]]))


def tidy(name: str) -> str:
    return name.strip().lstrip("﻿").strip()


def keep_first_position(pairs: Header) -> Header:
    """Drop later columns of the same name."""
    seen: dict[str, int] = {}
    for position, name in pairs:
        seen.setdefault(name, position)
    return [(position, name) for name, position in seen.items()]


def early_reading_columns() -> list[str]:
    """The canonical level columns of early reading."""
    return [f"{g.label} {level}" for g in EARLY_READING.groups for level in EARLY_READING.scale.levels]


def early_reading_header(names: Sequence[str]) -> Header:
    """Repair a typo, leave out grade totals, refuse unknown grade columns."""
    repaired = [tidy(n).replace(*LANGUAGE_TYPO) for n in names]
    kept = [
        (i, n) for i, n in enumerate(repaired) if not (n.startswith("G") and "total" in n.lower())
    ]
    canonical = set(early_reading_columns())
    unknown = sorted({n for _, n in kept if n.startswith("G") and n not in canonical})
    if unknown:
        raise ValueError(f"unexpected grade columns: {unknown}")
    return keep_first_position(kept)


def upper_reading_level_column(group: Group, level: str) -> str:
    """Canonical column of a level; the depth of a 7-level name stands before the language."""
    depth, _, severity = level.partition(" ")
    if depth in ("2LD", "3LD"):
        return f"{group.grade} {depth} {group.lang} {severity}"
    return f"{group.grade} {group.lang} {level}"


def upper_reading_columns(ks: str, school_year: str, period: str) -> list[str]:
    """The canonical data columns of one export of upper reading."""
    begin = period == "BoSY"
    scale = READING_7 if begin else READING_3
    per_language = ks == "ks3" and (begin or school_year == "2025-26")
    columns = []
    for grade in KEY_STAGE_GRADES[ks]:
        if not per_language:
            columns.append(f"{grade} Assessed")
        for lang in LANGUAGES:
            if per_language:
                columns.append(f"{grade} {lang} Assessed")
            columns += [upper_reading_level_column(Group(grade, lang), level) for level in scale.levels]
    return columns


def upper_reading_header(names: Sequence[str], ks: str, school_year: str, period: str) -> Header:
    """Bring level names into one order, drop repeated columns, mend a wrong enrolled header."""
    out = []
    for i, raw in enumerate(names):
        name = COPY_SUFFIX.sub("", tidy(raw))
        reversed_level = REVERSED_LEVEL.match(name)
        if reversed_level:
            grade, lang, severity, depth = reversed_level.groups()
            name = f"{grade} {depth}LD {lang} {severity}"
        if (ks, school_year, period) == ("ks3", "2024-25", "EoSY") and name == WRONG_ENROLLED[0]:
            name = WRONG_ENROLLED[1]
        out.append((i, name))
    kept = keep_first_position(out)
    if KEY not in {n for _, n in kept}:
        raise ValueError(f"no {KEY} column")
    return kept


def mathematics_columns(ks: str) -> list[str]:
    """The canonical data columns of one export of mathematics."""
    columns = []
    for grade in KEY_STAGE_GRADES[ks]:
        columns.append(f"{grade} Assessed")
        columns += [f"{grade} {level}" for level in MATH_5.levels]
    return columns


def mathematics_header(names: Sequence[str]) -> Header:
    """Use the municipality as district where there is no district."""
    tidied = [tidy(n) for n in names]
    if "District" not in tidied:
        tidied = ["District" if n == "Municipality" else n for n in tidied]
    return keep_first_position(list(enumerate(tidied)))


def header_report(header: Header, expected: Sequence[str]) -> dict[str, list[str]]:
    """Canonical columns that are present, missing, and extra columns."""
    names = {n for _, n in header}
    return {
        "present": [c for c in expected if c in names],
        "missing": [c for c in expected if c not in names],
        "extra": sorted(names - set(expected) - {KEY, *METADATA}),
    }
