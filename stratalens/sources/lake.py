"""The lake: partitioned Parquet for counts, entities and result tables, CSV for pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PARTITIONS = ("instrument", "school_year", "period")

# Known tables are read without looking into their files first.
_KEYS = "entity_id bigint, instrument string, school_year string, period string, ks string"
SCHEMAS = {
    "counts": f"grade string, lang string, counts array<double>, {_KEYS}",
    "entities": f"name string, region string, division string, district string, reported_total double, {_KEYS}",
    "assessed": f"grade string, lang string, assessed double, {_KEYS}",
    "quarantine": f"reason string, raw_id string, grade string, lang string, counts array<double>, cells map<string,string>, rows bigint, {_KEYS}",
}


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] = PARTITIONS, lookup: str | None = None, group_bytes: int = 16 << 20
) -> str:
    """Write a table; only the partitions present in ``df`` are replaced.

    The rebalance hint lets Spark cut every partition into files of sensible
    size: a large timepoint gets several writers, small ones share none.  With ``lookup`` every file is sorted by that
    column and has a Bloom filter on it per row group of ``group_bytes``, so that a filter on one value reads the few row
    groups that can hold it.
    """
    rows = df.hint("rebalance", *by)
    options = {}
    if lookup is not None:
        rows = rows.sortWithinPartitions(*by, lookup)
        options = {f"parquet.bloom.filter.enabled#{lookup}": "true", "parquet.block.size": str(group_bytes)}
    (
        rows.write.options(**options).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return path


def read_partitioned(
    spark: SparkSession,
    path: str,
    instrument: str | None = None,
    ks: str | None = None,
    timepoints: Sequence[tuple[str, str]] | None = None,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Read a lake table; the timepoints asked for prune its partitions, absent ones are no error."""
    df = spark.read.schema(schema or _schema_with_text_partitions(spark, path)).parquet(path)
    if instrument is not None:
        df = df.filter(F.col("instrument") == instrument)
    if ks is not None:
        df = df.filter(F.col("ks") == ks)
    if timepoints is not None:
        wanted = F.lit(False)
        for school_year, period in timepoints:
            wanted = wanted | ((F.col("school_year") == school_year) & (F.col("period") == period))
        df = df.filter(wanted)
    return df


def _schema_with_text_partitions(spark: SparkSession, path: str) -> StructType:
    """Partition values stay text, whatever they look like."""
    schema = spark.read.parquet(path).schema
    return StructType([
        StructField(f.name, StringType() if f.name in (*PARTITIONS, "ks") else f.dataType, True) for f in schema.fields
    ])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table can be read from a path."""
    try:
        spark.read.parquet(path).schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def write_table(df: DataFrame, path: str) -> str:
    """Write a result table."""
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv(df: DataFrame, folder: str, prefix: str, label: str) -> str:
    """Write one pairwise comparison as CSV with a header, in a folder named after its segment."""
    path = f"{folder}/{prefix}.{label}.csv"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_csv_partitioned(df: DataFrame, folder: str, prefix: str, by: str) -> str:
    """Write a table as CSV with a header, one folder per value of ``by``, in one job."""
    path = f"{folder}/{prefix}"
    df.hint("rebalance", by).write.mode("overwrite").option("header", True).partitionBy(by).csv(path)
    return path
