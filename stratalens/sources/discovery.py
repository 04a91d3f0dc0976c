"""Find the export to load for every timepoint."""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How the exports of upper reading and mathematics are named.
UPPER_READING_PATTERNS = {
    ("ks2", "2024-25", "BoSY"): "*Archive*Elementary*BoSY*",
    ("ks2", "2024-25", "EoSY"): "*Archive*Elementary*EoSY*",
    ("ks2", "2025-26", "BoSY"): "*KS2*BoSY*",
    ("ks2", "2025-26", "EoSY"): "*KS2*EoSY*",
    ("ks3", "2024-25", "BoSY"): "*Archive*Secondary*BoSY*",
    ("ks3", "2024-25", "EoSY"): "*Archive*Secondary*EoSY*",
    ("ks3", "2025-26", "BoSY"): "*KS3*BoSY*",
    ("ks3", "2025-26", "EoSY"): "*KS3*EoSY*",
}
MATHEMATICS_PATTERNS = {
    ("ks1", "2024-25", "EoSY"): "*KS1*Archive*2024-25*EoSY*",
    ("ks1", "2025-26", "BoSY"): "*(KS1)*BoSY*",
    ("ks1", "2025-26", "EoSY"): "*(KS1)*EoSY*",
    ("ks2", "2025-26", "BoSY"): "*(KS2)*BoSY*",
    ("ks2", "2025-26", "EoSY"): "*(KS2)*EoSY*",
    ("ks3", "2025-26", "BoSY"): "*(KS3)*BoSY*",
    ("ks3", "2025-26", "EoSY"): "*(KS3)*EoSY*",
}
EARLY_READING_ARCHIVE = {
    ("2024-25", "BoSY"): "{prefix} Results Archive_SY 2024-25 Assessment Results_Table_BoSY.csv",
    ("2024-25", "EoSY"): "{prefix} Results Archive_SY 2024-25 Assessment Results_Table_EoSY.csv",
    ("2025-26", "BoSY"): "{prefix} National Dashboard_BoSY 2025-26 Assessment Results_Table.csv",
}


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Paths below a folder as a DataFrame; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path")
    )


def latest_exports(paths: DataFrame, prefix: str) -> DataFrame:
    """Newest ``<prefix>_<period>_<year>_<timestamp>.csv`` per school year and period.

    An export may be a file or a folder of part files.  Other names are ignored.
    """
    pattern = rf"^(.*/)?({prefix}_(\w+)_(\d{{4}}-\d{{2}})_(\d{{8}}_\d{{6}})\.csv)(/.*)?$"
    path = F.col("path")
    named = paths.filter(path.rlike(pattern)).select(
        F.regexp_extract(path, pattern, 4).alias("school_year"),
        F.regexp_extract(path, pattern, 3).alias("period"),
        F.regexp_extract(path, pattern, 5).alias("_stamp"),
        F.concat(F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)).alias("path"),
    )
    return named.groupBy("school_year", "period").agg(F.max(F.struct("_stamp", "path")).alias("_last")).select(
        "school_year", "period", F.col("_last.path").alias("path")
    )


def registered_exports(paths: DataFrame, patterns: Mapping[tuple[str, str, str], str]) -> DataFrame:
    """Last path in name order per (key stage, school year, period) whose name fits the pattern."""
    name = F.element_at(F.split(F.regexp_replace("path", r"/part-[^/]*$", ""), "/"), -1)
    export = F.regexp_replace("path", r"/part-[^/]*$", "")

    def entry(key, glob) -> Column:
        fits = name.rlike(f"^{fnmatch.translate(glob)}")
        row = F.struct(*[F.lit(v).alias(n) for n, v in zip(("ks", "school_year", "period"), key, strict=True)])
        return F.when(fits, row)

    hits = paths.select(export.alias("path"), F.inline(F.array_compact(F.array(*[
        entry(key, glob) for key, glob in patterns.items()
    ]))))
    return hits.groupBy("ks", "school_year", "period").agg(F.max("path").alias("path"))


def missing_exports(found: DataFrame, patterns: Mapping[tuple[str, str, str], str]) -> DataFrame:
    """Registered timepoints without a file."""
    wanted = found.sparkSession.createDataFrame(list(patterns), "ks string, school_year string, period string")
    return wanted.join(found, ["ks", "school_year", "period"], "left_anti")


def archive_paths(folder: str, prefix: str) -> dict[tuple[str, str], str]:
    """The known archive files of early reading below a folder."""
    return {key: f"{folder}/{name.format(prefix=prefix)}" for key, name in EARLY_READING_ARCHIVE.items()}


def file_map(exports: DataFrame) -> dict[tuple[str, ...], str]:
    """Timepoint to path on the driver: one entry per registered timepoint."""
    keys = [c for c in ("ks", "school_year", "period") if c in exports.columns]
    return {tuple(row[k] for k in keys): row["path"] for row in exports.collect()}
