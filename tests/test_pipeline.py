"""Exports to lake to result tables and ranking, on small files."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratalens.plans import pipeline, segments
from stratalens.plans.ranking import with_capacity
from stratalens.plans.segments import make_segment
from stratalens.scales import EARLY_READING, KEY_STAGE_GRADES, MATH_5
from stratalens.sources import bronze, headers, lake

YEARS = {"2024-25": ("BoSY", "EoSY"), "2025-26": ("BoSY", "MoSY", "EoSY")}
SCHOOLS = range(101, 113)


def early_rows(seed):
    rng = random.Random(seed)
    return {
        s: {c: rng.randint(5, 9) if c.endswith(("Developing", "Transitioning")) else rng.randint(1, 9) for c in headers.early_reading_columns()}
        for s in SCHOOLS
    }


def write_csv(path, rows, extra):
    path.parent.mkdir(parents=True, exist_ok=True)
    frame = pd.DataFrame([{"School ID": s, **extra(s), **cells} for s, cells in rows.items()])
    frame.to_csv(path, index=False)


@pytest.fixture(scope="module")
def early(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("early")
    data = {}
    for i, (y, p) in enumerate((y, p) for y, chain in YEARS.items() for p in chain):
        rows = early_rows(i)
        if (y, p) == ("2025-26", "EoSY"):
            rows.pop(112)
        data[(y, p)] = rows
        write_csv(root / f"in/EX_{p}_{y}_20260101_000000.csv", rows, lambda s: {
            "School Name": f"School {s}", "Region": "R ", "Division": "D", "District": "T", "Total Assessed": 100 + s % 3,
        })
    path = str(root / "lake")
    pipeline.load_early_reading(spark, str(root / "in"), path, "EX")
    return path, data, root


def moments(cells):
    w = np.arange(1, 6)
    out = []
    for g in EARLY_READING.groups:
        p = np.array([cells[f"{g.label} {level}"] for level in EARLY_READING.scale.levels], float)
        p /= p.sum()
        m = (p * w).sum()
        sd = np.sqrt((p * (w - m) ** 2).sum())
        out.append((m, sd, (p * (w - m) ** 3).sum() / sd**3, p[-1] * 100))
    return np.mean(out, axis=0)


def test_early_reading_tables(spark, early):
    path, data, _ = early
    tables = pipeline.early_reading_tables(spark, path)
    rows = {(r["entity_id"], r["school_year"], r["period"]): r for r in tables["timepoints"].collect()}
    assert len(rows) == 12 * 5 - 1
    for (y, p), schools in data.items():
        for s, cells in schools.items():
            r = rows[(s, y, p)]
            want = moments(cells)
            assert [r.ordinal_mean, r.ordinal_sd, r.ordinal_skew, r.pct_gl] == pytest.approx(list(want))
            assert r.total_assessed == 100 + s % 3 and r.total_source == "reported" and r.groups_with_data == 6
            assert r.name == f"School {s}" and r.region == "R" and r.timepoint_label == f"{p} {y}"
    assert {"ordinal_G1", "ordinal_G2", "ordinal_G3", "ordinal_G2_MT", "ordinal_G3_Eng", "ordinal_overall"} <= set(tables["timepoints"].columns)
    changes = tables["segments"].collect()
    assert len(changes) == 12 * 7
    for r in changes:
        (y0, p0), (y1, p1) = (tuple(reversed(t.split(" "))) for t in (r.tp_from, r.tp_to))
        if r.entity_id in data[(y1, p1)]:
            a, b = moments(data[(y0, p0)][r.entity_id]), moments(data[(y1, p1)][r.entity_id])
            assert r.delta_mean == pytest.approx(b[0] - a[0]) and r.delta_skew == pytest.approx(b[2] - a[2])
        else:
            assert r.delta_mean is None


def test_reload_replaces_one_timepoint(spark, early):
    path, data, root = early
    newer = early_rows(99)
    write_csv(root / "more/EX_MoSY_2025-26_20260202_000000.csv", newer, lambda s: {"Region": "X"})
    copy = str(root / "copy")
    for table in ("counts", "entities"):
        lake.write_partitioned(lake.read_partitioned(spark, f"{path}/{table}"), f"{copy}/{table}", (*lake.PARTITIONS, "ks"))
    pipeline.load_early_reading(spark, str(root / "more"), copy, "EX")
    rows = pipeline.early_reading_tables(spark, copy)["timepoints"].filter("entity_id = 101").collect()
    by = {(r.school_year, r.period): r for r in rows}
    assert len(by) == 5 and by[("2025-26", "MoSY")].ordinal_mean == pytest.approx(moments(newer[101])[0])
    assert by[("2025-26", "MoSY")].total_source == "derived"
    assert by[("2024-25", "BoSY")].ordinal_mean == pytest.approx(moments(data[("2024-25", "BoSY")][101])[0])


def test_build_ranking_writes_net_gains(spark, early):
    path, _, root = early
    schools = spark.createDataFrame(
        [(s, "NCR", "North", "c0", "City 0") for s in SCHOOLS],
        "entity_id bigint, psgc_region string, psgc_province string, area_code string, area_name string",
    )
    funds = spark.createDataFrame(
        [("NCR", "North", "City 0", "City", 1000.0)],
        "region string, province string, area string, area_type string, rpt_special_education_fund double",
    )
    cohort = spark.createDataFrame([(101,)], "entity_id bigint")
    written = pipeline.build_ranking(spark, path, str(root / "ranked"), schools, funds, cohort)
    want = {f"net_gain_{k}_{y}" for k in ("upper", "top") for y in ("2024_25", "2025_26")}
    assert len(written) == 2
    for stored in (spark.read.parquet(x) for x in written):
        assert want <= set(stored.columns) and stored.count() > 0
        assert stored.where("net_gain_top_2024_25 IS NOT NULL").count() > 0
    with pytest.raises(TypeError):
        pipeline.composite_ranking(schools, schools, schools, cohort)


def test_ranking_and_reference(spark, early):
    path, data, root = early
    counts = pipeline.lake_table(spark, path, "counts", EARLY_READING.name)
    entities = pipeline.lake_table(spark, path, "entities", EARLY_READING.name)
    scored = pipeline.scored_timepoints(counts, entities, EARLY_READING)
    schools = spark.createDataFrame(
        # The last school is listed twice.
        [(s, "NCR", "North", f"c{s % 4}", f"City {s % 4}") for s in (*SCHOOLS, max(SCHOOLS))],
        "entity_id bigint, psgc_region string, psgc_province string, area_code string, area_name string",
    )
    funds = spark.createDataFrame(
        [("NCR", "North", f"City {i}", "City", 1000.0 * (i + 1)) for i in range(4)],
        "region string, province string, area string, area_type string, rpt_special_education_fund double",
    )
    enrollment = spark.createDataFrame([(s, 10.0) for s in (*SCHOOLS, max(SCHOOLS))], "entity_id bigint, enrolled double")
    areas, capacity = pipeline.capacity_tables(schools, funds, enrollment)
    assert {r.area_code: r.fund_per_learner for r in capacity.collect()} == {f"c{i}": 1000.0 * (i + 1) / 30 for i in range(4)}
    cohort = spark.createDataFrame([(101,), (112,), (999,)], "entity_id bigint")
    out = pipeline.composite_ranking(scored, areas, capacity, cohort, counts=counts)
    ranked = out["ranking"].collect()
    reference = {r.entity_id: r for r in out["reference"].collect()}
    assert len(reference) == 12 and reference[112].valid_composite == "No"
    assert reference[112].exclusion_reason == "SY 2025-26: not in EoSY dataset" and reference[112].in_cohort == "Yes"
    good = {s for s, r in reference.items() if r.valid_composite == "Yes"}
    assert {r.entity_id for r in ranked} == good and good
    scores = [r.priority_score for r in ranked]
    assert scores == sorted(scores, reverse=True)
    one = reference[min(good)]
    assert one.mean_2025_26 == pytest.approx(moments(data[("2025-26", "EoSY")][min(good)])[0])
    assert one.exclusion_reason == "" and one.municipality == f"City {min(good) % 4}"
    gains = {(r.entity_id, r.school_year): r for r in pipeline.yearly_net_gains(counts, ["2024-25", "2025-26"]).collect()}
    top = lambda cells: sum(v for c, v in cells.items() if c.endswith("Grade Level"))
    assert gains[(101, "2024-25")].net_gain_top == top(data[("2024-25", "EoSY")][101]) - top(data[("2024-25", "BoSY")][101])
    assert gains[(112, "2025-26")].net_gain_top is None
    assert one.net_gain_top_2024_25 == gains[(min(good), "2024-25")].net_gain_top
    assert all(r.net_gain_upper_2025_26 == gains[(r.entity_id, "2025-26")].net_gain_upper for r in ranked)
    assert len(ranked) == len({r.entity_id for r in ranked})
    stored = pipeline.write_ranking(out, str(root / "gold"))
    assert [spark.read.parquet(x).count() for x in stored] == [len(ranked), 12]
    steps = [make_segment(0, ("2024-25", "EoSY"), ("2025-26", "BoSY"))]
    assert len(pipeline.export_pairs(counts, scored, EARLY_READING, str(root / "steps"), "progress", segments=steps)) == 1
    written = pipeline.export_pairs(counts, scored, EARLY_READING, str(root / "pairs"), "progress")
    assert len(written) == 7
    first = spark.read.option("header", True).csv(written[0])
    assert first.count() == 12 and "BoSY 2024-25 Developing %" in first.columns


def test_upper_reading_and_mathematics_tables(spark, tmp_path):
    rng = random.Random(7)
    for ks, names in (("ks2", ("Archive Elementary {p}", "Dash KS2 {p}")), ("ks3", ("Archive Secondary {p}", "Dash KS3 {p}"))):
        for y, name in zip(("2024-25", "2025-26"), names):
            for p in ("BoSY", "EoSY"):
                columns = headers.upper_reading_columns(ks, y, p)
                rows = {s: {c: rng.randint(1, 9) for c in columns} for s in (1, 2, 3)}
                if p == "EoSY":
                    rows.pop(3)
                write_csv(tmp_path / "upper" / (name.format(p=p) + ".csv"), rows, lambda s: {"Region": "R"})
    for ks, grades in KEY_STAGE_GRADES.items():
        for p in ("BoSY", "EoSY"):
            columns = [f"{g} {level}" for g in grades for level in MATH_5.levels]
            write_csv(tmp_path / "math" / f"Dash ({ks.upper()}) {p}.csv", {s: {c: rng.randint(1, 9) for c in columns} for s in (1, 2)},
                      lambda s: {"Municipality": "M", "Total Assessed": "1,000"})
    path = str(tmp_path / "lake")
    pipeline.load_early_reading(spark, write_early(tmp_path), path, "EX")
    pipeline.load_upper_reading(spark, str(tmp_path / "upper"), path)
    pipeline.load_mathematics(spark, str(tmp_path / "math"), path)
    for ks in ("ks2", "ks3"):
        tables = pipeline.upper_reading_tables(spark, path, ks)
        points = tables["timepoints"].collect()
        assert len(points) == 10
        for r in points:
            assert (r.pct_grade_ready is None) == (r.period == "EoSY") and r.ordinal_mean <= 3 and r.region == "R"
            assert r.total_assessed > 0 and r.groups_with_data == (6 if ks == "ks2" else 8)
        assert tables["segments"].count() == 6 and tables["segments"].filter("delta_mean is null").count() == 2
        assert tables["bosy_yoy"].count() == 3 and tables["bosy_yoy"].filter("emd_mean is null").count() == 0
    counts = pipeline.lake_table(spark, path, "counts", "upper_reading", "ks2")
    begin = counts.filter("period = 'BoSY' and entity_id = 1 and school_year = '2024-25'")
    wide = bronze.load_upper_reading(spark, str(tmp_path / "upper/Archive Elementary BoSY.csv"), "ks2", "2024-25", "BoSY")
    want = wide.filter("entity_id = 1").select(sum((F.col(f"`{g} Assessed`").cast("double") for g in KEY_STAGE_GRADES["ks2"]), F.lit(0.0))).first()[0]
    got = pipeline.upper_reading_tables(spark, path, "ks2")["timepoints"].filter("entity_id = 1 and period = 'BoSY' and school_year = '2024-25'").first()
    assert got.total_assessed == want and begin.count() == 6
    for ks in KEY_STAGE_GRADES:
        tables = pipeline.mathematics_tables(spark, path, ks)
        assert tables["timepoints"].count() == 4 and tables["timepoints"].first().total_assessed == 1000
        segment = tables["segments"].collect()
        assert [(r.seg_idx, r.segment_label) for r in segment] == [(0, "Learning_2025-26")] * 2
    written = pipeline.build_all(spark, path, str(tmp_path / "gold"))
    assert len(written) == 2 + 2 * 3 + 3 * 2 and spark.read.parquet(written[0]).count() == 12


def write_early(tmp_path):
    write_csv(tmp_path / "early/EX_BoSY_2024-25_20260101_000000.csv", early_rows(1), lambda s: {"Region": "R"})
    return str(tmp_path / "early")


def test_absent_lake_tables_are_empty(spark, tmp_path):
    assert pipeline.lake_table(spark, str(tmp_path), "counts", "mathematics", "ks1").count() == 0
    tables = pipeline.mathematics_tables(spark, str(tmp_path), "ks1")
    assert tables["timepoints"].count() == 0 and tables["segments"].count() == 0


CHAINS = [
    {"2024-25": ("BoSY", "EoSY"), "2025-26": ("BoSY", "MoSY", "EoSY")},
    {"1999": ("BoSY",), "2000": ("MoSY", "EoSY"), "2001": ("BoSY", "MoSY", "EoSY")},
    {"2001": ("EoSY",)}, {"2001": ("BoSY",), "2002": ("BoSY",)}, {"a": ("BoSY", "EoSY", "Extra"), "b": ("EoSY",)}, {},
]


@pytest.mark.parametrize("chains", CHAINS)
def test_segments_from_data_are_those_of_chains(spark, chains):
    rows = [(y, p) for y, chain in chains.items() for p in chain] * 2 + [(None, "BoSY"), ("2001", None)]
    timepoints = segments.present_timepoints(spark.createDataFrame(rows, "school_year string, period string"))
    want = [(s.index, s.label, s.kind, s.start, s.end, s.start_label, s.end_label) for s in segments.build_segments(chains)]
    assert [tuple(r) for r in segments.present_segments(timepoints).orderBy("seg_idx").collect()] == want
    points, listed = segments.present_chain(timepoints)
    assert listed == segments.build_segments(chains) and points == [f"{p} {y}" for y, chain in chains.items() for p in chain]
    learning = [(s.index, s.label) for s in segments.learning_segments(chains)]
    assert [(r.seg_idx, r.segment_label) for r in segments.present_learning(timepoints).orderBy("seg_idx").collect()] == learning
    years = spark.createDataFrame([(y,) for y in chains] + [(None,)], "y string")
    steps = [(s.index, s.label, s.start, s.end) for s in segments.consecutive_segments(list(chains))]
    assert [(r.seg_idx, r.segment_label, r.tp0, r.tp1) for r in segments.present_steps(years).orderBy("seg_idx").collect()] == steps


def lake_rows(spark, years, instrument="mathematics", ks="ks1"):
    rows = [(s, instrument, y, p, ks, "G1", None, [1.0 + s, 2.0, 3.0, float(p == "EoSY"), 1.0]) for y, chain in years.items() for p in chain for s in (1, 2)]
    return spark.createDataFrame(rows, "entity_id bigint, instrument string, school_year string, period string, ks string, grade string, lang string, counts array<double>")


def test_a_year_that_is_listed_nowhere_has_its_segments(spark, tmp_path):
    years = {"2024-25": ("BoSY", "EoSY"), "2025-26": ("BoSY",), "2031-32": ("BoSY", "EoSY")}
    for instrument, ks in (("mathematics", "ks1"), ("early_reading", None)):
        lake.write_partitioned(lake_rows(spark, years, instrument, ks), f"{tmp_path}/lake/counts", (*lake.PARTITIONS, "ks"))
    found = pipeline.mathematics_tables(spark, f"{tmp_path}/lake", "ks1")["segments"].collect()
    # The year without an end has no segment, and those behind it move up.
    assert sorted({(r.seg_idx, r.segment_label) for r in found}) == [(0, "Learning_2024-25"), (1, "Learning_2031-32")] and len(found) == 4
    labels = {r.segment_label for r in pipeline.early_reading_tables(spark, f"{tmp_path}/lake")["segments"].collect()}
    assert {"Learning_2031-32", "YoY_BoSY_2024-25_to_2031-32", "EndToEnd_2024-25_to_2031-32"} <= labels


def test_load_keeps_what_it_cannot_use(spark, tmp_path):
    def export(rows, folder, keys):
        frame = pd.DataFrame([{"School ID": keys.get(s, s), "School Name": f"S {s}", "Region": "R", **cells} for s, cells in rows.items()])
        (tmp_path / folder).mkdir()
        frame.to_csv(tmp_path / folder / "EX_BoSY_2024-25_20260101_000000.csv", index=False)

    rows = early_rows(3)
    rows[102]["G1 Developing"] = -4
    export(rows, "first", {101: "n/a", 105: ""})
    path = str(tmp_path / "lake")
    load = pipeline.load_early_reading(spark, str(tmp_path / "first"), path, "EX", multi_line=False)
    assert (load.read, load.accepted, load.rejected) == (12, 10, 2)
    found = pipeline.lake_table(spark, path, "quarantine", EARLY_READING.name)
    by = {k: found.where(F.col("reason") == k).collect() for k in (bronze.BAD_KEY, bronze.NEGATIVE, bronze.LOAD)}
    assert sorted(r.raw_id or "" for r in by[bronze.BAD_KEY]) == ["", "n/a"]
    assert {r.cells["School Name"] for r in by[bronze.BAD_KEY]} == {"S 101", "S 105"}
    assert by[bronze.BAD_KEY][0].cells["G2 Fil Developing"] in {str(rows[s]["G2 Fil Developing"]) for s in (101, 105)}
    (negative,) = by[bronze.NEGATIVE]
    assert (negative.entity_id, negative.grade, negative.lang) == (102, "G1", None) and min(negative.counts) == -4
    assert [r.rows for r in by[bronze.LOAD]] == [12]
    assert pipeline.lake_table(spark, path, "entities", EARLY_READING.name).count() == 10
    # A later load without faults takes their place.
    export(early_rows(4), "second", {})
    assert pipeline.load_early_reading(spark, str(tmp_path / "second"), path, "EX").rejected == 0
    assert [r.reason for r in pipeline.lake_table(spark, path, "quarantine", EARLY_READING.name).collect()] == [bronze.LOAD]


def test_one_export_holds_all_segments(spark, early, tmp_path):
    path, _, _ = early
    counts = pipeline.lake_table(spark, path, "counts", EARLY_READING.name)
    scored = pipeline.scored_timepoints(counts, pipeline.lake_table(spark, path, "entities", EARLY_READING.name), EARLY_READING)
    weights = {level: 10.0 * i for i, level in enumerate(EARLY_READING.scale.levels)}
    written, schema = pipeline.export_all_pairs(counts, scored, EARLY_READING, str(tmp_path), "progress", weights=weights)
    back = spark.read.option("header", True).schema(schema).csv(written)
    labelled = counts.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    listed = segments.build_segments(YEARS)
    assert {r.segment_label for r in back.select("segment_label").distinct().collect()} == {s.label for s in listed}
    for s in listed:
        one = pipeline.pairwise_table(labelled, scored, EARLY_READING, s, weights=weights, metadata=pipeline.PLACES)
        renamed = one.toDF(*[c.replace(s.start_label, "From").replace(s.end_label, "To") for c in one.columns])
        want = sorted(map(str, renamed.select(*sorted(f"`{c}`" for c in renamed.columns)).collect()))
        mine = back.where(F.col("segment_label") == s.label).drop("segment_label", "tp_from", "tp_to")
        assert sorted(map(str, mine.select(*sorted(f"`{c}`" for c in mine.columns)).collect())) == want


def test_entities_without_area_are_dealt_out(spark):
    entities = spark.range(4000).select(F.col("id").alias("e"))
    areas = spark.range(100).select(F.col("id").alias("e"), (F.col("id") % 3).alias("area"))
    capacity = spark.createDataFrame([(0, 1.5), (1, 2.5)], "area bigint, fund_per_learner double")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false")):
            spark.conf.set(k, v)
        joined = with_capacity(entities, areas, capacity, "e", "area")
        found = joined.withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rows = {r.e: (r.area, r.fund_per_learner) for r in found}
    held = Counter(r.p for r in found if r.area is None)
    assert len(held) == 8 and max(held.values()) < 2 * min(held.values())
    assert rows == {e: (e % 3, (1.5, 2.5, None)[e % 3]) if e < 100 else (None, None) for e in range(4000)}
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
