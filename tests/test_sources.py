import csv
import pytest
from pyspark.sql import functions as F

from stratalens.functions.text import place_name, region_short, repaired, to_key, to_number
from stratalens.scales import READING_3, READING_7
from stratalens.sources import bronze, discovery, headers, lake


def write(path, header, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")
    return str(path)


def test_numbers_and_keys(spark):
    df = spark.createDataFrame([("2,814",), ("-",), ("",), ("nan",), (" 5 ",), ("12%",), ("5d",), (None,), ("101.0",)], "x string")
    got = df.select(to_number(F.col("x")), to_key(F.col("x"))).collect()
    assert [r[0] for r in got] == [2814, None, None, None, 5, None, None, None, 101]
    assert [r[1] for r in got] == [2814, None, None, None, 5, None, None, None, 101]


def test_names(spark):
    names = ["City of San José (Capital)", "Municipality of Dasol", "Doña Remedios", "Due¤as", "Cebu City", None, "  BARMM "]
    df = spark.createDataFrame([(n,) for n in names], "x string")
    assert [r[0] for r in df.select(place_name(F.col("x"))).collect()] == [
        "san josé", "dasol", "dona remedios", "duenas", "cebu", "", "barmm"
    ]
    fixed = spark.createDataFrame([(" DoÃ±a",), ("Due¤as",), (" x ",)], "x string").select(repaired(F.col("x")))
    assert [r[0] for r in fixed.collect()] == ["Doña", "Dueñas", "x"]
    regions = spark.createDataFrame([("Region V (Bicol Region)",), (" CARAGA",), ("Mars ",), (None,)], "x string")
    assert [r[0] for r in regions.select(region_short(F.col("x"))).collect()] == ["Region V", "Region XIII", "Mars", None]


def test_early_reading_header_rules():
    names = ["﻿Region", "School ID", "G2 FIl Higher Emergent", "G2 Fil Higher Emergent", "G1 Total Assessed", "Total Assessed"]
    assert headers.early_reading_header(names) == [
        (0, "Region"), (1, "School ID"), (2, "G2 Fil Higher Emergent"), (5, "Total Assessed")
    ]
    with pytest.raises(ValueError, match="G4 Something"):
        headers.early_reading_header(["School ID", "G4 Something"])


def test_upper_reading_header_rules():
    names = ["School ID", "G7 Fil Frustration 2Level", "G5 3LD Fil Frustration", "G5 3LD Fil Frustration.1", "Total Enrolled (G4-G6)"]
    got = headers.upper_reading_header(names, "ks3", "2024-25", "EoSY")
    assert got == [(0, "School ID"), (1, "G7 2LD Fil Frustration"), (2, "G5 3LD Fil Frustration"), (4, "Total Enrolled (G7-G10)")]
    assert headers.upper_reading_header(names, "ks2", "2024-25", "EoSY")[-1] == (4, "Total Enrolled (G4-G6)")
    sizes = [("ks2", "2024-25", "BoSY", 45), ("ks3", "2024-25", "BoSY", 64), ("ks2", "2025-26", "EoSY", 21),
             ("ks3", "2024-25", "EoSY", 28), ("ks3", "2025-26", "EoSY", 32)]
    for ks, year, period, n in sizes:
        assert len(headers.upper_reading_columns(ks, year, period)) == n
    report = headers.header_report(got, ["G7 2LD Fil Frustration", "G7 Fil Grade Ready"])
    assert report["missing"] == ["G7 Fil Grade Ready"] and report["present"] == ["G7 2LD Fil Frustration"]
    with pytest.raises(ValueError):
        headers.upper_reading_header(["Region"], "ks2", "2024-25", "BoSY")


def test_early_reading_export(spark, tmp_path):
    header = '﻿Region,School ID,School Name,Total Assessed,G1 Grade Level,G1 Lower Emergent,G2 FIl Higher Emergent,G1 Total Assessed'
    path = write(tmp_path / "a.csv", header, 'BARMM ,"1,001",Due¤as,"2,814",3,"1,000",-,9', "X,n/a,Y,1,1,1,1,1")
    wide = bronze.load_early_reading(spark, path, "2024-25", "BoSY")
    assert bronze.rejected(wide).first().raw_id == "n/a"
    entity = bronze.entity_rows(wide, "early_reading").first()
    assert (entity.entity_id, entity.name, entity.region, entity.reported_total) == (1001, "Dueñas", "BARMM", 2814)
    counts = {(r.grade, r.lang): r.counts for r in bronze.early_reading_counts(wide).collect()}
    assert counts[("G1", None)] == [1000, None, None, None, 3] and counts[("G2", "Fil")] == [None] * 5 and len(counts) == 6


def test_exports_with_other_columns_are_united_by_name(spark, tmp_path):
    a = write(tmp_path / "a.csv", "School ID,G1 Developing,G1 Transitioning", "1,5,6")
    b = write(tmp_path / "b.csv", "G1 Transitioning,School ID,G1 Developing", "6,1,5")
    both = bronze.load_all_early_reading(spark, {("2024-25", "BoSY"): a, ("2025-26", "BoSY"): b})
    rows = bronze.early_reading_counts(both).filter("grade = 'G1'").collect()
    assert [r.counts for r in rows] == [[None, None, 5, 6, None]] * 2 and {r.school_year for r in rows} == {"2024-25", "2025-26"}


def test_upper_reading_export(spark, tmp_path):
    header = "School ID,School Name,G7 Fil Assessed,G7 Fil Grade Ready,G7 Fil Frustration 3Level,G7 Fil Frustration 3Level"
    path = write(tmp_path / "u.csv", header, "7.0,S,9,4,5,99")
    wide = bronze.load_upper_reading(spark, path, "ks3", "2024-25", "BoSY")
    counts = {(r.grade, r.lang): r.counts for r in bronze.upper_reading_counts(wide, "ks3", READING_7).collect()}
    assert counts[("G7", "Fil")] == [5, None, None, None, None, None, 4] and len(counts) == 8
    assessed = bronze.assessed_counts(wide, "ks3").filter("assessed is not null").collect()
    assert [(r.entity_id, r.grade, r.lang, r.assessed) for r in assessed] == [(7, "G7", "Fil", 9)]
    assert bronze.upper_reading_scale("EoSY") is READING_3


def test_mathematics_export(spark, tmp_path):
    header = "School ID,Municipality,Total Assessed,G1 Emerging Not Proficient"
    path = write(tmp_path / "m.csv", header, '3,Town ," 1,200 ", 7 ')
    wide = bronze.load_mathematics(spark, path, "ks1", "2025-26", "BoSY")
    entity = bronze.entity_rows(wide, "mathematics", "ks1").first()
    assert entity.district == "Town" and entity.reported_total == 1200
    first = bronze.mathematics_counts(wide, "ks1").filter("grade = 'G1'").first()
    assert first.counts == [7, None, None, None, None] and first.ks == "ks1"


def test_negative_counts_are_reported(spark):
    df = spark.createDataFrame([(1, [1.0, -2.0]), (2, [1.0, None])], "entity_id int, counts array<double>")
    assert [r.entity_id for r in bronze.unusable_counts(df, 2).collect()] == [1]


def test_discovery(spark, tmp_path):
    for name in ("EX_BoSY_2025-26_20260101_000000.csv", "EX_BoSY_2025-26_20260319_090545.csv", "EX_EoSY_2024-25_20250101_000000.csv",
                 "EX_BoSY_2025-26.csv", "other.csv"):
        write(tmp_path / "in" / name, "School ID", "1")
    found = discovery.file_map(discovery.latest_exports(discovery.list_files(spark, str(tmp_path / "in")), "EX"))
    assert {k: v.rsplit("/", 1)[1] for k, v in found.items()} == {
        ("2025-26", "BoSY"): "EX_BoSY_2025-26_20260319_090545.csv", ("2024-25", "EoSY"): "EX_EoSY_2024-25_20250101_000000.csv",
    }
    for name in ("Dash (KS1) BoSY a.csv", "Dash (KS1) BoSY b.csv", "KS1 Results Archive_SY 2024-25 EoSY.csv", "KS1 Results Archive_SY 2023-24 EoSY.csv"):
        write(tmp_path / "math" / name, "School ID", "1")
    paths = discovery.list_files(spark, str(tmp_path / "math"))
    found = discovery.registered_exports(paths, discovery.MATHEMATICS_PATTERNS)
    by_key = discovery.file_map(found)
    assert by_key[("ks1", "2025-26", "BoSY")].endswith("BoSY b.csv")
    assert by_key[("ks1", "2024-25", "EoSY")].endswith("2024-25 EoSY.csv") and len(by_key) == 2
    assert bronze.read_header(spark, by_key[("ks1", "2025-26", "BoSY")]) == ["School ID"]
    assert discovery.missing_exports(found, discovery.MATHEMATICS_PATTERNS).count() == 5
    assert discovery.archive_paths("in", "EX")[("2024-25", "BoSY")].startswith("in/EX Results Archive")


def test_lake(spark, tmp_path):
    rows = [("a", "2024-25", "BoSY", 1), ("a", "2025-26", "BoSY", 2), ("b", "2024-25", "BoSY", 3)]
    df = spark.createDataFrame(rows, "instrument string, school_year string, period string, entity_id bigint")
    path = str(tmp_path / "lake")
    assert not lake.exists(spark, path)
    lake.write_partitioned(df, path)
    lake.write_partitioned(df.filter("instrument = 'b'").withColumn("entity_id", F.lit(9)), path)
    assert lake.exists(spark, path)
    assert {r.entity_id for r in lake.read_partitioned(spark, path).collect()} == {1, 2, 9}
    some = lake.read_partitioned(spark, path, "a", timepoints=[("2025-26", "BoSY"), ("2030-31", "EoSY")])
    assert [r.entity_id for r in some.collect()] == [2]
    assert "PartitionFilters: [isnotnull(instrument" in some._jdf.queryExecution().toString().replace("\n", " ")


def test_side_tables(spark, tmp_path):
    schools = "Unused,BEIS School ID,Region,Division,(PSGC) REGION NAME,(PSGC) PROVINCE NAME,(PSGC) MUNCIPAL/CITY,(PSGC) MUNCIPAL/CITY NAME"
    path = write(tmp_path / "s.csv", "title,,,,,,,", *["note,,,,,,,"] * 5, schools, "x,11,R,D,NR,P,0101,City of A", "x,bad,R,D,NR,P,0101,City of A")
    row = bronze.load_school_areas(spark, path).collect()
    assert [(r.entity_id, r.area_code, r.area_name, r.psgc_province) for r in row] == [(11, "0101", "City of A", "P")]
    cells = {1: "R1", 2: "P1", 3: "A", 4: "City", 6: '"1,500.5"', 32: "-"}
    body = ",".join(cells.get(i, "") for i in range(33))
    path = write(tmp_path / "f.csv", ",".join(["head"] * 33), body, body.replace("City", "Total"))
    fund = bronze.load_area_funds(spark, path).collect()
    assert len(fund) == 1 and fund[0].rpt_special_education_fund == 1500.5
    assert fund[0].total_current_operating_expenditure is None and len(fund[0]) == 25
    path = write(tmp_path / "e.csv", "school_id,g1_male,g1_female,g1_total", '5,"1,000",2,7', "6,,3,1")
    assert {r.entity_id: r.enrolled for r in bronze.load_enrollment(spark, path).collect()} == {5: 1002, 6: 3}
    path = write(tmp_path / "ids.txt", "12", "", " 13 ", "12")
    assert sorted(r.entity_id for r in bronze.load_id_list(spark, path).collect()) == [12, 13]


def test_quoted_text_in_exports(spark, tmp_path):
    """Doubled quotes, commas behind them and line breaks stay in their column."""
    from stratalens.sources.bronze import read_positional

    names = ['San Jose "A", Annex', "two\nlines", 'plain, with comma', '"', ""]
    with open(tmp_path / "e.csv", "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(["School ID", "School Name", "Total"])
        writer.writerows([i, n, 5 + i] for i, n in enumerate(names))
    got = read_positional(spark, str(tmp_path / "e.csv"), 3, [(0, "id"), (1, "name"), (2, "total")]).orderBy("id").collect()
    assert [(r.id, r.name or "", r.total) for r in got] == [(str(i), n, str(5 + i)) for i, n in enumerate(names)]
