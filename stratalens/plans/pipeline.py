"""From folders of exports to the lake, and from the lake to the result tables.

A lake has three tables, each partitioned by instrument, school year and period:
``counts`` (level counts per group), ``entities`` (names, places, reported
total) and ``assessed`` (assessed columns per group), and beside them
``quarantine``, rows and groups that cannot be used.  Loading one more export
replaces its own partition only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.distribution import collapse
from ..operators.counts import largest_language_parts, upper_counts
from ..operators.keysets import keep_first
from ..operators.matching import match_areas, matched, normalised
from ..scales import (
    EARLY_READING,
    KEY_STAGE_GRADES,
    READING_3,
    READING_7,
    SEVEN_TO_THREE,
    Instrument,
    mathematics,
    upper_reading,
)
from ..session import materialise
from ..sources import bronze, discovery, lake
from .chain import chain_progress
from .gold import (
    KEYS,
    begin_total,
    depth_aggregates,
    segment_table,
    timepoint_table,
    timepoints_with_total,
    with_depth,
    year_over_year,
)
from .pairwise import pairwise_rows, pairwise_table
from .ranking import area_capacity, composite_inputs, rank_entities, tag_cohort, with_capacity
from .reference import REASON_FIELDS, ReportYear, reference_table, with_reasons
from .scoring import score_timepoints
from .segments import (
    BEGIN,
    DEFAULT_CHAINS,
    END,
    Segment,
    build_segments,
    make_segment,
    present_learning,
    present_segments,
    present_timepoints,
    timepoint_label,
)

PLACES = ("name", "region", "division", "district")
FUND = "rpt_special_education_fund"


# Exports to lake ---------------------------------------------------------------


def store(
    wide: DataFrame, to_counts: Callable[[DataFrame], DataFrame], instrument: str, ks: str | None, path: str,
    to_assessed: Callable[[DataFrame], DataFrame] | None = None,
) -> bronze.Loaded:
    """Write one instrument's rows to the lake, and what cannot be used beside them.

    The export is parsed once.  While it is written for the passes that follow, Spark counts rows read, accepted and
    rejected, and while the lake is written, rows stored.  Rows without a usable key and groups with a negative count stand in
    ``quarantine``, partitioned like the lake.  A load whose numbers do not add up is an error.
    """
    read, kept = Observation(), Observation()
    usable = F.col("entity_id").isNotNull()
    wide = materialise(wide.observe(
        read, F.count(F.lit(1)).alias("read"), F.count_if(usable).alias("accepted"), F.count_if(~usable).alias("rejected")
    ))
    by = (*lake.PARTITIONS, "ks")
    counts = to_counts(wide)
    lake.write_partitioned(counts, f"{path}/counts", by)
    entities = bronze.entity_rows(wide, instrument, ks)
    lake.write_partitioned(entities.observe(kept, F.count(F.lit(1)).alias("stored")), f"{path}/entities", by)
    if to_assessed is not None:
        lake.write_partitioned(to_assessed(wide), f"{path}/assessed", by)
    lake.write_partitioned(bronze.quarantine_rows(wide, counts, instrument, ks), f"{path}/quarantine", by)
    seen, stored = read.get, kept.get["stored"]
    if seen["read"] != seen["accepted"] + seen["rejected"] or stored != seen["accepted"]:
        raise ValueError(f"{instrument}: {seen['read']} rows read, {seen['accepted']} accepted, {seen['rejected']} rejected, {stored} stored")
    return bronze.Loaded(seen["read"], seen["accepted"], seen["rejected"])


def load_early_reading(spark: SparkSession, folder: str, path: str, prefix: str, multi_line: bool = True) -> bronze.Loaded:
    """Newest exports of early reading to the lake.

    ``multi_line=False`` lets Spark split large files whose quoted text has no line breaks; so do the other loaders.
    """
    files = discovery.latest_exports(discovery.list_files(spark, folder, "*.csv"), prefix)
    wide = bronze.load_all_early_reading(spark, discovery.file_map(files), multi_line)
    return store(wide, bronze.early_reading_counts, EARLY_READING.name, None, path)


def load_upper_reading(
    spark: SparkSession, folder: str, path: str, patterns: Mapping = discovery.UPPER_READING_PATTERNS, multi_line: bool = True
) -> list[bronze.Loaded]:
    """Exports of upper reading to the lake, begin of year on 7 levels, end on 3."""
    found = discovery.file_map(discovery.registered_exports(discovery.list_files(spark, folder), patterns))
    loads = []
    for (ks, school_year, period), file in sorted(found.items()):
        wide = bronze.load_upper_reading(spark, file, ks, school_year, period, multi_line)
        scale = bronze.upper_reading_scale(period)

        def assessed(df: DataFrame, ks: str = ks) -> DataFrame:
            return bronze.assessed_counts(df, ks).withColumns({"instrument": F.lit("upper_reading"), "ks": F.lit(ks)})

        loads.append(store(wide, partial(bronze.upper_reading_counts, ks=ks, scale=scale), "upper_reading", ks, path, assessed))
    return loads


def load_mathematics(
    spark: SparkSession, folder: str, path: str, patterns: Mapping = discovery.MATHEMATICS_PATTERNS, multi_line: bool = True
) -> list[bronze.Loaded]:
    """Exports of mathematics to the lake."""
    found = discovery.file_map(discovery.registered_exports(discovery.list_files(spark, folder), patterns))
    return [
        store(
            bronze.load_mathematics(spark, file, ks, school_year, period, multi_line), partial(bronze.mathematics_counts, ks=ks),
            "mathematics", ks, path,
        )
        for (ks, school_year, period), file in sorted(found.items())
    ]


# Lake to result tables ------------------------------------------------------------


def lake_table(spark: SparkSession, path: str, table: str, instrument: str, ks: str | None = None) -> DataFrame:
    """A table of the lake, pruned to one instrument and key stage; a table not loaded yet is empty."""
    if not lake.exists(spark, f"{path}/{table}"):
        return spark.createDataFrame([], lake.SCHEMAS[table])
    return lake.read_partitioned(spark, f"{path}/{table}", instrument, ks, schema=lake.SCHEMAS[table])


def described(table: DataFrame, entities: DataFrame) -> DataFrame:
    """Add the timepoint label and the names and places of each entity."""
    places = keep_first(entities.select(*KEYS, *PLACES), KEYS, [F.col(c) for c in PLACES])
    labelled = table.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    return labelled.join(places, list(KEYS), "left")


def early_reading_tables(
    spark: SparkSession, path: str, chains: Mapping[str, Sequence[str]] | None = None
) -> dict[str, DataFrame]:
    """Timepoint and segment tables of early reading; segments are those of ``chains``, else of the timepoints in the lake."""
    counts = lake_table(spark, path, "counts", EARLY_READING.name)
    entities = lake_table(spark, path, "entities", EARLY_READING.name)
    table = timepoints_with_total(counts, entities, EARLY_READING).withColumn("ordinal_overall", F.col("ordinal_mean"))
    return {
        "timepoints": described(table, entities).withColumnRenamed("pct_top_level", "pct_gl"),
        "segments": segment_table(
            counts, EARLY_READING, present_segments(present_timepoints(counts)) if chains is None else build_segments(chains)
        ),
    }


def upper_reading_tables(
    spark: SparkSession, path: str, ks: str, years: tuple[str, str] | None = None
) -> dict[str, DataFrame]:
    """Timepoint, segment and year-over-year tables of upper reading.

    Segments are those of the years in the lake; ``years`` are the two compared, else its first and last.  Begin-of-year counts are collapsed to three levels for the first two tables;
    the third keeps the seven levels.
    """
    three, seven = upper_reading(ks, READING_3), upper_reading(ks, READING_7)
    counts = lake_table(spark, path, "counts", "upper_reading", ks)
    entities = lake_table(spark, path, "entities", "upper_reading", ks)
    begin = counts.filter(F.col("period") == BEGIN)
    end = counts.filter(F.col("period") == END)
    common = with_depth(begin).withColumn("counts", collapse("counts", SEVEN_TO_THREE.mapping)).unionByName(
        end.withColumns({c: F.lit(None).cast("double") for c in ("_ready", "_deep")})
    )
    largest, total = largest_language_parts(three.grades, 3)
    table = timepoint_table(common, three, scores_by_group=False, extra=[*depth_aggregates(), *largest])
    table = table.withColumn("total_assessed", total).drop("pct_top_level")
    assessed = None
    if ks == "ks2":
        assessed = lake_table(spark, path, "assessed", "upper_reading", ks).filter(F.col("period") == BEGIN)
    begin_totals = begin_total(begin, seven.grades, assessed)
    if assessed is not None:
        reported = begin_totals.withColumnRenamed("total_assessed", "_reported")
        table = table.join(reported, list(KEYS), "left").withColumn(
            "total_assessed", F.coalesce("_reported", "total_assessed")
        )
    table = table.drop(*[c for c in table.columns if c.startswith("_")])
    if years is None:
        ends = begin.agg(F.min("school_year").alias("first"), F.max("school_year").alias("last")).first()
        years = (ends.first or "", ends.last or "")
    yoy = make_segment(0, (years[0], BEGIN), (years[-1], BEGIN))
    return {
        "timepoints": described(table, entities).withColumn("ks", F.lit(ks)),
        "segments": segment_table(common, three, present_learning(present_timepoints(common))).withColumn("ks", F.lit(ks)),
        "bosy_yoy": year_over_year(begin, begin_totals, seven, yoy).withColumn("ks", F.lit(ks)),
    }


def mathematics_tables(spark: SparkSession, path: str, ks: str) -> dict[str, DataFrame]:
    """Timepoint and segment tables of mathematics; segments are numbered without gaps over the years in the lake."""
    instrument = mathematics(ks)
    counts = lake_table(spark, path, "counts", "mathematics", ks)
    entities = lake_table(spark, path, "entities", "mathematics", ks)
    reported = entities.groupBy(*KEYS).agg(F.max("reported_total").alias("total_assessed"))
    table = timepoint_table(counts, instrument, scores_by_group=False).join(reported, list(KEYS), "left")
    return {
        "timepoints": described(table, entities).withColumn("ks", F.lit(ks)).withColumnRenamed("pct_top_level", "pct_aglhp"),
        "segments": segment_table(counts, instrument, present_learning(present_timepoints(counts))).withColumn("ks", F.lit(ks)),
    }


def write_tables(tables: Mapping[str, DataFrame], folder: str, name: str) -> list[str]:
    """Write result tables as ``<folder>/<name>_<table>``."""
    return [lake.write_table(df, f"{folder}/{name}_{table}") for table, df in tables.items()]


def build_all(spark: SparkSession, path: str, folder: str) -> list[str]:
    """All result tables the lake has data for."""
    written = write_tables(early_reading_tables(spark, path), folder, "early_reading")
    for ks in KEY_STAGE_GRADES:
        if ks != "ks1":
            written += write_tables(upper_reading_tables(spark, path, ks), folder, f"upper_reading_{ks}")
        written += write_tables(mathematics_tables(spark, path, ks), folder, f"mathematics_{ks}")
    return written


# Lake to rankings ---------------------------------------------------------------------


def scored_timepoints(
    counts: DataFrame, entities: DataFrame, instrument: Instrument, scoring: str = "ordinal", **options
) -> DataFrame:
    """Scores, flags, names and total (reported, else derived) per entity and timepoint."""
    labelled = counts.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    keys = ["entity_id", "timepoint_label"]
    scored = score_timepoints(labelled, instrument, keys, scoring, **options)
    named = entities.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    totals = named.groupBy(*keys).agg(F.max("reported_total").alias("reported_total"))
    places = keep_first(named.select(*keys, *PLACES), keys, [x for p in PLACES for x in (F.col(p).isNull(), F.col(p))])
    return scored.join(places.join(totals, keys), keys, "left").withColumn(
        "total_assessed", F.coalesce("reported_total", "derived_total")
    )


def capacity_tables(
    schools: DataFrame, funds: DataFrame, enrollment: DataFrame | None = None, fund: str = FUND
) -> tuple[DataFrame, DataFrame]:
    """Entity-to-area table and fund per learner of each area, from the raw side tables."""
    crosswalk = normalised(schools, "psgc_region", "psgc_province", "area_name")
    found = matched(match_areas(funds, crosswalk)).select("area_code", F.col("area").alias("area_name"), F.col(fund).alias("fund"))
    areas = crosswalk.select("entity_id", "area_code", "psgc_province", F.col("area_name").alias("municipality"))
    # A school listed twice keeps its first row, so that it is ranked once.
    areas = keep_first(areas, ["entity_id"], [x for c in ("area_code", "psgc_province", "municipality") for x in (F.col(c).isNull(), F.col(c))])
    # One row per area, read by the ranking and by the reference table.
    return areas, materialise(area_capacity(areas, found, "entity_id", "area_code", enrollment))


def composite_ranking(
    scored: DataFrame,
    areas: DataFrame,
    capacity: DataFrame,
    cohort: DataFrame,
    counts: DataFrame,
    chains: Mapping[str, Sequence[str]] = DEFAULT_CHAINS,
) -> dict[str, DataFrame]:
    """Ranking over the full-year segments of all years, and the reference table of all entities.

    Both have the net gains of every year, from ``counts``, the long counts that the scores come from.
    """
    points = [timepoint_label(y, p) for y in sorted(chains) for p in chains[y]]
    segments = build_segments(chains)
    numbers = {s.label: s.index + 1 for s in segments}
    years = sorted(y for y in chains if f"Learning_{y}" in numbers)
    learning = [numbers[f"Learning_{y}"] for y in years]
    progress = chain_progress(scored, "entity_id", points, segments, PLACES, carry=REASON_FIELDS)
    last = points.index(timepoint_label(years[-1], END))
    inputs = composite_inputs(progress, "entity_id", learning, last, PLACES)
    ranked = rank_entities(with_capacity(inputs, areas, capacity, "entity_id", "area_code"), "entity_id")
    report = [
        ReportYear(f"SY {y}", y.replace("-", "_"), timepoint_label(y, BEGIN), timepoint_label(y, END), n)
        for y, n in zip(years, learning, strict=True)
    ]
    reasons = with_capacity(with_reasons(progress, report, points), areas, capacity, "entity_id", "area_code")
    extra = [
        *PLACES, "psgc_province", "municipality", F.col("area_name"), F.col("fund_per_learner"),
        *[F.col(f"perf_{points.index(y.end)}").alias(f"mean_{y.suffix}") for y in report],
        *[F.col(f"total_assessed_{points.index(p)}").alias(f"assessed_{name}_{y.suffix}")
          for y in report for name, p in (("begin", y.start), ("end", y.end))],
    ]
    gains = net_gains_by_year(counts, years)
    extra += [F.col(c) for c in gains.columns if c != "entity_id"]
    ranked = ranked.join(gains, "entity_id", "left")
    reasons = reasons.join(gains, "entity_id", "left")
    return {
        "ranking": tag_cohort(ranked, cohort, "entity_id").orderBy(F.desc("priority_score"), F.asc("entity_id")),
        "reference": reference_table(reasons, "entity_id", report, cohort, extra),
    }


def write_ranking(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Write the ranking and the reference table of ``composite_ranking``."""
    return write_tables(tables, folder, "composite")


def build_ranking(
    spark: SparkSession,
    path: str,
    folder: str,
    schools: DataFrame,
    funds: DataFrame,
    cohort: DataFrame,
    enrollment: DataFrame | None = None,
    chains: Mapping[str, Sequence[str]] = DEFAULT_CHAINS,
) -> list[str]:
    """Ranking and reference table of early reading, from the lake and the raw side tables to ``folder``."""
    counts = lake_table(spark, path, "counts", EARLY_READING.name)
    entities = lake_table(spark, path, "entities", EARLY_READING.name)
    areas, capacity = capacity_tables(schools, funds, enrollment)
    scored = scored_timepoints(counts, entities, EARLY_READING)
    return write_ranking(composite_ranking(scored, areas, capacity, cohort, counts, chains), folder)


def net_gains_by_year(counts: DataFrame, years: Sequence[str]) -> DataFrame:
    """One row per entity with ``net_gain_upper_<year>`` and ``net_gain_top_<year>``."""
    gains = yearly_net_gains(counts, years)
    cells = [
        F.max(F.when(F.col("school_year") == y, F.col(c))).alias(f"{c}_{y.replace('-', '_')}")
        for y in years for c in ("net_gain_upper", "net_gain_top")
    ]
    return gains.groupBy("entity_id").agg(*cells)


def yearly_net_gains(counts: DataFrame, years: Sequence[str], size: int = 5) -> DataFrame:
    """Net gain on the two best levels and on the best, begin to end, per entity and year."""
    ends = counts.filter(F.col("school_year").isin(list(years)) & F.col("period").isin(BEGIN, END))
    per_end = upper_counts(ends, ["entity_id", "school_year", "period"], size)

    def at(period: str, column: str):
        return F.max(F.when(F.col("period") == period, F.col(column)))

    return per_end.groupBy("entity_id", "school_year").agg(
        (at(END, "upper_count") - at(BEGIN, "upper_count")).alias("net_gain_upper"),
        (at(END, "top_count") - at(BEGIN, "top_count")).alias("net_gain_top"),
    )


def export_pairs(
    counts: DataFrame,
    scored: DataFrame,
    instrument: Instrument,
    folder: str,
    prefix: str,
    chains: Mapping[str, Sequence[str]] = DEFAULT_CHAINS,
    weights: Mapping[str, float] | None = None,
    segments: Sequence[Segment] | None = None,
) -> list[str]:
    """One CSV per segment: those given, such as the steps of a flat chain of timepoints, else those of the chains."""
    labelled = counts.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    return [
        lake.export_csv(
            pairwise_table(labelled, scored, instrument, s, weights=weights, metadata=PLACES), folder, prefix, s.label
        )
        for s in (build_segments(chains) if segments is None else segments)
    ]


def export_all_pairs(
    counts: DataFrame,
    scored: DataFrame,
    instrument: Instrument,
    folder: str,
    prefix: str,
    segments: DataFrame | None = None,
    weights: Mapping[str, float] | None = None,
    metadata: Sequence[str] = PLACES,
) -> tuple[str, StructType]:
    """All segments in one job: CSV files partitioned by ``segment_label`` below one folder, with a common header; also their schema.

    The columns say ``From`` and ``To`` where ``export_pairs`` has the timepoints.  Segments are those of the timepoints in
    ``counts`` unless given as a table.
    """
    if segments is None:
        segments = present_segments(present_timepoints(counts))
    labelled = counts.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    rows = pairwise_rows(labelled, scored, instrument, segments, weights=weights, metadata=metadata)
    path = lake.export_csv_partitioned(rows, folder, prefix, "segment_label")
    return path, StructType([*(f for f in rows.schema if f.name != "segment_label"), rows.schema["segment_label"]])
