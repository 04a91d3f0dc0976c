"""Loaders: CSV exports to wide tables with canonical columns, and to the rows of the lake.

A wide table has typed keys, metadata and total; its level cells stay text until
they stand in long rows, so that no stage converts dozens of columns at once.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import repaired, to_key, to_number, trimmed
from ..operators.counts import wide_to_long
from ..scales import (
    EARLY_READING,
    KEY_STAGE_GRADES,
    MATH_5,
    METADATA,
    READING_3,
    READING_7,
    Group,
    Scale,
    mathematics,
    upper_reading,
)
from .headers import (
    KEY,
    Header,
    early_reading_columns,
    early_reading_header,
    mathematics_columns,
    mathematics_header,
    read_header,
    upper_reading_columns,
    upper_reading_header,
    upper_reading_level_column,
)

TOTAL = "Total Assessed"


def read_positional(
    spark: SparkSession, path: str, width: int, header: Header, has_header: bool = True, multi_line: bool = True
) -> DataFrame:
    """Read a CSV as text by position and give the kept columns their canonical names.

    Quotes inside quoted text are doubled, as spreadsheets write them, and quoted text may
    hold line breaks.  ``multi_line=False`` lets Spark split a single large file that has none.
    """
    schema = ", ".join(f"c{i} string" for i in range(width))
    raw = (
        spark.read.schema(schema)
        .option("header", has_header)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return raw.select(*[F.col(f"c{i}").alias(name) for i, name in header])


def _optional(df: DataFrame, name: str, clean, kind: str) -> Column:
    """A cleaned column, or NULL where the export lacks it."""
    return clean(F.col(f"`{name}`")) if name in df.columns else F.lit(None).cast(kind)


def _canonical(df: DataFrame, columns: Sequence[str], clean_text, tags: Mapping[str, str]) -> DataFrame:
    """Key, metadata, total and data columns in canonical order, plus constant tags."""
    return df.select(
        F.col(f"`{KEY}`").alias("raw_id"),
        to_key(F.col(f"`{KEY}`")).alias("entity_id"),
        *[_optional(df, m, clean_text, "string").alias(m) for m in METADATA],
        _optional(df, TOTAL, to_number, "double").alias("total_assessed"),
        *[_optional(df, c, lambda x: x, "string").alias(c) for c in columns],
        *[F.lit(v).alias(n) for n, v in tags.items()],
    )


def load_early_reading(spark: SparkSession, path: str, school_year: str, period: str, multi_line: bool = True) -> DataFrame:
    """One export of early reading, columns and text repaired."""
    names = read_header(spark, path)
    raw = read_positional(spark, path, len(names), early_reading_header(names), multi_line=multi_line)
    return _canonical(raw, early_reading_columns(), repaired, {"school_year": school_year, "period": period})


def load_all_early_reading(spark: SparkSession, files: Mapping[tuple[str, str], str], multi_line: bool = True) -> DataFrame:
    """Several exports of early reading in one table; columns are matched by name."""
    return union_all([load_early_reading(spark, path, *key, multi_line) for key, path in sorted(files.items())])


def load_upper_reading(spark: SparkSession, path: str, ks: str, school_year: str, period: str, multi_line: bool = True) -> DataFrame:
    """One export of upper reading."""
    names = read_header(spark, path)
    raw = read_positional(spark, path, len(names), upper_reading_header(names, ks, school_year, period), multi_line=multi_line)
    tags = {"school_year": school_year, "period": period, "ks": ks}
    return _canonical(raw, upper_reading_columns(ks, school_year, period), lambda c: c, tags)


def load_mathematics(spark: SparkSession, path: str, ks: str, school_year: str, period: str, multi_line: bool = True) -> DataFrame:
    """One export of mathematics."""
    names = read_header(spark, path)
    raw = read_positional(spark, path, len(names), mathematics_header(names), multi_line=multi_line)
    tags = {"school_year": school_year, "period": period, "ks": ks}
    return _canonical(raw, mathematics_columns(ks), trimmed, tags)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that one frame lacks is NULL there."""
    if not frames:
        raise ValueError("there is no export to load")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def accepted(wide: DataFrame) -> DataFrame:
    """Rows with a usable key."""
    return wide.filter(F.col("entity_id").isNotNull()).drop("raw_id")


def rejected(wide: DataFrame) -> DataFrame:
    """Rows without one, as they stood in the export."""
    return wide.filter(F.col("entity_id").isNull())


def unusable_counts(counts: DataFrame, size: int | None = None) -> DataFrame:
    """Groups with a negative count, or with other than ``size`` levels; their distribution is left empty everywhere else."""
    negative = F.exists("counts", lambda c: c < 0)
    return counts.filter(negative if size is None else negative | (F.size("counts") != size))


@dataclass(frozen=True)
class Loaded:
    """Rows of a load."""

    read: int
    accepted: int
    rejected: int


# Why something stands in the quarantine, and the row that reports a load.
BAD_KEY, NEGATIVE, LOAD = "bad_key", "negative_count", "load"


def quarantine_rows(wide: DataFrame, counts: DataFrame, instrument: str, ks: str | None) -> DataFrame:
    """What a load cannot use, in the shape of the lake's ``quarantine``.

    A row without a usable key keeps its key as text and its other non-empty cells by column name; a group with a negative
    count keeps its counts.  One row per timepoint with the reason ``load`` has the number of rows read, so
    that a load without faults replaces the quarantine of an earlier one too.
    """
    nothing = {"raw_id": "string", "entity_id": "bigint", "grade": "string", "lang": "string", "counts": "array<double>", "cells": "map<string,string>"}

    def shaped(df: DataFrame, reason: str, **known: Column) -> DataFrame:
        cells = [known.get(c, F.lit(None)).cast(t).alias(c) for c, t in nothing.items()]
        return df.select(
            F.lit(reason).alias("reason"), *cells, known.get("rows", F.lit(1)).cast("bigint").alias("rows"),
            F.lit(instrument).alias("instrument"), F.lit(ks).cast("string").alias("ks"), "school_year", "period",
        )

    kept = [c for c in wide.columns if c not in ("raw_id", "entity_id", "school_year", "period", "ks")]
    pairs = F.array(*(F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for c in kept))
    cells = F.map_from_entries(F.filter(pairs, lambda x: x["value"].isNotNull()))
    loads = wide.groupBy("school_year", "period").agg(F.count(F.lit(1)).alias("_rows"))
    negative = unusable_counts(counts)
    group = {c: F.col(c) for c in ("entity_id", "grade", "lang", "counts")}
    return (
        shaped(rejected(wide), BAD_KEY, raw_id=F.col("raw_id"), cells=cells)
        .unionByName(shaped(negative, NEGATIVE, **group))
        .unionByName(shaped(loads, LOAD, rows=F.col("_rows")))
    )


KEYS = ("entity_id", "school_year", "period")


def _lake_rows(wide: DataFrame, instrument: str, ks: str | None, groups, scale: Scale, column_name=None) -> DataFrame:
    rows = wide_to_long(accepted(wide), KEYS, groups, scale, column_name, convert=to_number)
    return rows.select(F.lit(instrument).alias("instrument"), F.lit(ks).cast("string").alias("ks"), *KEYS, "grade", "lang", "counts")


def early_reading_counts(wide: DataFrame) -> DataFrame:
    """Level counts per group, in the shape of the lake."""
    return _lake_rows(wide, EARLY_READING.name, None, EARLY_READING.groups, EARLY_READING.scale)


def upper_reading_counts(wide: DataFrame, ks: str, scale: Scale) -> DataFrame:
    """Level counts per grade and language on the 3- or the 7-level scale."""
    groups = upper_reading(ks).groups
    return _lake_rows(wide, "upper_reading", ks, groups, scale, upper_reading_level_column)


def mathematics_counts(wide: DataFrame, ks: str) -> DataFrame:
    """Level counts per grade."""
    return _lake_rows(wide, "mathematics", ks, mathematics(ks).groups, MATH_5)


def assessed_counts(wide: DataFrame, ks: str) -> DataFrame:
    """The assessed columns per grade (and language, where the export has them so)."""
    cells = []
    for grade in KEY_STAGE_GRADES[ks]:
        for lang in (None, "Fil", "Eng"):
            name = f"{Group(grade, lang).label} Assessed"
            if name in wide.columns:
                cells.append(F.struct(
                    F.lit(grade).alias("grade"),
                    F.lit(lang).cast("string").alias("lang"),
                    F.col(f"`{name}`").alias("assessed"),
                ))
    rows = accepted(wide).select(*KEYS, F.inline(F.array(*cells)))
    return rows.withColumn("assessed", to_number(F.col("assessed")))


def entity_rows(wide: DataFrame, instrument: str, ks: str | None = None) -> DataFrame:
    """Names, places and reported total per entity and timepoint."""
    return accepted(wide).select(
        F.lit(instrument).alias("instrument"),
        F.lit(ks).cast("string").alias("ks"),
        *KEYS,
        F.col("`School Name`").alias("name"),
        F.col("Region").alias("region"),
        F.col("Division").alias("division"),
        F.col("District").alias("district"),
        F.col("total_assessed").alias("reported_total"),
    )


def upper_reading_scale(period: str) -> Scale:
    """The scale an export of upper reading is written in."""
    return READING_7 if period == "BoSY" else READING_3


# Side tables -----------------------------------------------------------------

# Columns of the school database that are renamed or kept.
SCHOOL_COLUMNS = {
    "BEIS School ID": "School ID",
    "Region": "Region",
    "Division": "Division",
    "(PSGC) REGION NAME": "psgc_region",
    "(PSGC) PROVINCE NAME": "psgc_province",
    "(PSGC) MUNCIPAL/CITY": "area_code",
    "(PSGC) MUNCIPAL/CITY NAME": "area_name",
}
SCHOOL_HEADER_ROW = 6

# Position and meaning of the columns of the local fund table.
FUND_COLUMNS = {
    1: "region",
    2: "province",
    3: "area",
    4: "area_type",
    5: "rpt_general_fund",
    6: "rpt_special_education_fund",
    7: "rpt_total",
    8: "tax_on_business",
    9: "other_taxes",
    10: "total_tax_revenue",
    11: "nontax_regulatory_fees",
    12: "nontax_service_charges",
    13: "nontax_economic_enterprises",
    14: "nontax_other_receipts",
    15: "total_nontax_revenue",
    16: "total_local_sources",
    17: "national_tax_allotment",
    18: "other_national_tax_shares",
    19: "inter_local_transfers",
    20: "extraordinary_receipts",
    21: "total_external_sources",
    22: "total_current_operating_income",
    24: "expenditure_education_culture_sports",
    29: "total_social_services_expenditure",
    32: "total_current_operating_expenditure",
}
FUND_TYPES = ("Province", "City", "Municipality")


def load_school_areas(spark: SparkSession, path: str, header_row: int = SCHOOL_HEADER_ROW) -> DataFrame:
    """School database: the header stands in a later row, the data below it.

    Rows without a numeric key are dropped, which takes the lines above the
    header with it.
    """
    lines = spark.read.text(path).take(header_row + 1)
    names = next(csv.reader([lines[header_row][0]]))
    header = [(names.index(source), target) for source, target in SCHOOL_COLUMNS.items()]
    raw = read_positional(spark, path, len(names), header, has_header=False)
    return raw.withColumn("entity_id", to_key(F.col("`School ID`"))).filter(F.col("entity_id").isNotNull()).select(
        "entity_id", *[c for c in SCHOOL_COLUMNS.values() if c != KEY]
    )


def load_area_funds(spark: SparkSession, path: str) -> DataFrame:
    """Fund table by column position; only provinces, cities and municipalities are rows of it."""
    raw = read_positional(spark, path, max(FUND_COLUMNS) + 1, list(FUND_COLUMNS.items()), has_header=False)
    text = list(FUND_COLUMNS.values())[:4]
    return raw.filter(F.col("area_type").isin(*FUND_TYPES)).select(
        *text, *[to_number(F.col(c)).alias(c) for c in FUND_COLUMNS.values() if c not in text]
    )


def load_enrollment(spark: SparkSession, path: str) -> DataFrame:
    """Learners per school: the sum of all columns by sex."""
    names = read_header(spark, path)
    raw = read_positional(spark, path, len(names), list(enumerate(names)))
    return enrolled(raw, "school_id")


def enrolled(df: DataFrame, key: str) -> DataFrame:
    """Sum of the columns that end in ``_male`` or ``_female``; missing ones count as zero."""
    parts = [c for c in df.columns if c.endswith(("_male", "_female"))]
    total = F.lit(0.0)
    for c in parts:
        total = total + F.coalesce(to_number(F.col(c).cast("string")), F.lit(0.0))
    return df.select(to_key(F.col(key).cast("string")).alias("entity_id"), total.alias("enrolled"))


def load_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One key per line; blank lines are ignored."""
    lines = spark.read.text(path)
    return lines.select(to_key(F.col("value")).alias("entity_id")).filter(F.col("entity_id").isNotNull()).distinct()
