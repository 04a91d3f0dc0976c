from pyspark.sql import functions as F

from stratalens.operators.validity import count_mismatch, failure_stage, validity
from stratalens.plans.chain import chain_long, chain_progress, segment_summary
from stratalens.plans.gold import segment_table
from stratalens.plans.reference import REASON_FIELDS, ReportYear, with_reasons
from stratalens.plans.scoring import score_timepoints
from stratalens.plans.segments import (
    DEFAULT_CHAINS,
    build_segments,
    learning_segments,
    make_segment,
)
from stratalens.scales import EARLY_READING, mathematics

SCHEMA = "entity_id bigint, school_year string, period string, grade string, lang string, counts array<double>"
GROUPS = [(g.grade, g.lang) for g in EARLY_READING.groups]


def school(entity, sums, year="2024-25", period="BoSY"):
    """One row per group, all learners of a group spread over two levels."""
    return [
        (entity, year, period, g, lang, [None] * 5 if n is None else [float(n - n // 2), 0.0, 0.0, 0.0, float(n // 2)])
        for (g, lang), n in zip(GROUPS, sums)
    ]


def test_strict_thresholds(spark):
    rows = (
        school(1, [15, 15, 15, 15, None, None]) + school(2, [14, 15, 15, 15, None, None])
        + school(3, [15, 15, 15, None, None, None]) + school(4, [15, 15, None, 15, None, None])
        + school(5, [20, 20, 20, None, None, 20]) + school(6, [None] * 6) + school(7, [0, 20, 20, 20, 20, 20])
    )
    flags = validity(spark.createDataFrame(rows, SCHEMA), ["entity_id"], EARLY_READING.groups, 5)
    got = {r.entity_id: r for r in flags.withColumn("stage", failure_stage()).collect()}
    assert [got[i].valid_strict for i in range(1, 8)] == [True, False, False, False, True, False, False]
    assert [got[i].stage for i in range(1, 8)] == [
        "strict", "small_group", "missing_grade", "few_groups", "strict", "no_data", "missing_grade"
    ]
    assert got[2].min_group_assessed == 14 and got[6].min_group_assessed is None
    assert got[3].groups_available == 3 and not got[7].has_G1 and got[5].has_G3_Eng


def test_mismatch_of_unknown_counts(spark):
    df = spark.createDataFrame([(100.0, 126.0), (100.0, 125.0), (None, 1.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(count_mismatch(a, b)).collect()] == [True, False, True]
    assert [r[0] for r in df.select(count_mismatch(a, b, unknown=False)).collect()] == [True, False, False]


def test_default_segments():
    segments = build_segments()
    assert [s.label for s in segments] == [
        "Learning_2024-25", "BoSYMoSY_2025-26", "MoSYEoSY_2025-26", "Learning_2025-26",
        "YoY_BoSY_2024-25_to_2025-26", "YoY_EoSY_2024-25_to_2025-26", "EndToEnd_2024-25_to_2025-26",
    ]
    assert [s.index for s in segments] == list(range(7))
    chains = {"2024-25": ("EoSY",), "2025-26": ("BoSY", "EoSY")}
    assert [(s.index, s.label) for s in learning_segments(chains)] == [(0, "Learning_2025-26")]
    assert make_segment(0, ("2024-25", "EoSY"), ("2025-26", "BoSY")).label == "EoSY_2024-25_to_BoSY_2025-26"


def test_segments_keep_the_start_side(spark):
    rows = (
        school(1, [10] * 6) + school(1, [10] * 6, period="EoSY") + school(2, [10] * 6)
        + school(3, [10] * 6, period="EoSY")
    )
    segments = [s for s in build_segments() if s.label == "Learning_2024-25"]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.entity_id: r for r in segment_table(df, EARLY_READING, segments).collect()}
    assert set(got) == {1, 2} and got[1].delta_mean == 0 and got[1].emd_mean == 0 and got[1].groups_common == 6
    assert got[2].delta_mean is None and got[2].emd_mean is None
    both = segment_table(df, EARLY_READING, segments, keep="both").collect()
    either = segment_table(df, EARLY_READING, segments, keep="either").collect()
    assert {r.entity_id for r in both} == {1} and {r.entity_id for r in either} == {1, 2, 3}


def test_row_count_over_all_segments(spark):
    points = [(y, p) for y, chain in DEFAULT_CHAINS.items() for p in chain]
    rows = []
    for i, (y, p) in enumerate(points):
        for entity in range(i + 1):
            rows += school(entity, [5] * 6, y, p)
    sizes = {f"{p} {y}": i + 1 for i, (y, p) in enumerate(points)}
    segments = build_segments()
    got = segment_table(spark.createDataFrame(rows, SCHEMA), EARLY_READING, segments)
    assert got.count() == sum(sizes[s.start] for s in segments)


def chain(spark, rows):
    points = ["BoSY 2024-25", "EoSY 2024-25", "BoSY 2025-26", "MoSY 2025-26", "EoSY 2025-26"]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    scored = score_timepoints(df, EARLY_READING, ["entity_id", "timepoint_label"], scoring="ordinal")
    scored = scored.withColumnRenamed("derived_total", "total_assessed").withColumn("name", F.lit("n"))
    return points, chain_progress(scored, "entity_id", points, build_segments(), ["name"], carry=REASON_FIELDS)


def test_chain_progress_and_reasons(spark):
    full = [20] * 6
    rows = []
    for y, p in (("2024-25", "BoSY"), ("2024-25", "EoSY"), ("2025-26", "BoSY"), ("2025-26", "EoSY")):
        rows += school(1, full, y, p)
        rows += school(2, full if p == "BoSY" else [40] * 6, y, p)
        rows += school(3, full if y == "2025-26" else [20, 20, 20, None, 20, 14], y, p)
    rows += school(4, full, "2024-25", "BoSY") + school(4, [20, 20, None, None, None, None], "2025-26", "BoSY")
    rows += school(5, [None] * 6, "2024-25", "BoSY")
    points, progress = chain(spark, rows)
    years = [
        ReportYear("SY 2024-25", "2024_25", "BoSY 2024-25", "EoSY 2024-25", 1),
        ReportYear("SY 2025-26", "2025_26", "BoSY 2025-26", "EoSY 2025-26", 4),
    ]
    got = {r.entity_id: r for r in with_reasons(progress, years, points).collect()}
    assert got[1].exclusion_reason == "" and got[1].composite_score == 0 and got[1].segments_available == 5
    assert got[1].name == "n" and got[1].segments_available_strict == 5
    unstable = "unstable count (>25% change)"
    assert got[2].exclusion_reason == f"SY 2024-25: {unstable} | SY 2025-26: {unstable}"
    assert got[2].composite_score is None and got[2].seg1_delta is None
    assert got[3].exclusion_reason == "SY 2024-25: min 14 assessed/group at BoSY; min 14 assessed/group at EoSY"
    assert got[3].seg1_valid and not got[3].seg1_valid_strict and got[3].seg1_delta == 0
    assert got[4].exclusion_reason == (
        "SY 2024-25: not in EoSY dataset | "
        "SY 2025-26: missing grade level(s) at BoSY; only 2 groups at BoSY; "
        "min 20 assessed/group at BoSY; not in EoSY dataset"
    ).replace("min 20 assessed/group at BoSY; ", "")
    assert got[5].exclusion_reason.startswith("SY 2024-25: no valid groups at BoSY; not in EoSY dataset | ")
    loaded = with_reasons(progress, years, points, loaded=points[:3]).collect()
    assert "no EoSY data" in {r.entity_id: r for r in loaded}[4].exclusion_reason
    summary = {r.segment_label: r for r in segment_summary(chain_long(progress, "entity_id", build_segments())).collect()}
    assert summary["Learning_2024-25"].entities == 5 and summary["Learning_2024-25"].n_strict == 1


def test_mathematics_groups_have_no_language(spark):
    rows = [(1, "2025-26", "BoSY", g, None, [20.0] * 5) for g in ("G1", "G2", "G3")]
    flags = validity(spark.createDataFrame(rows, SCHEMA), ["entity_id"], mathematics("ks1").groups, 5, min_groups=3)
    assert flags.first().valid_strict
