"""Exports written, found, loaded, stored in the lake and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.distribution import levels
from ..operators.counts import long_to_wide, records_to_counts
from ..plans import pipeline
from ..scales import EARLY_READING, MATH_5, READING_5, READING_7, mathematics, upper_reading
from ..session import materialise
from ..sources import bronze, discovery, lake
from .registry import (
    SQL_WEEKDAY,
    SQL_YEAR,
    customer_counts,
    line_timepoints,
    order_period,
    order_year,
    priority_level,
    query,
    r,
    rounded,
    sales_counts,
    scratch,
    sql_counts,
    sql_learning,
    sql_moments,
    sql_shares,
    table,
    weekday_level,
)
from .rankings import SUPPLY_LEVEL
from .segments import CHANGES_OUT, sql_changes


def number_text(column):
    """Counts as an export prints them: with thousands separators."""
    return F.format_number(column, 0)


def write_export(df, path, names):
    """Write selected columns as text under export names."""
    df.select(*[c.alias(n) for n, c in names]).write.option("header", True).csv(path)


GROUP_SQL = {"G1": ("A", "F"), "G2 MT": ("A", "O"), "G2 Fil": ("N", "F"), "G3 MT": ("N", "O"), "G3 Fil": ("R", "F"), "G3 Eng": ("R", "O")}
GROUP_OF = {pair: label for label, pair in GROUP_SQL.items()}
LABEL_CASE = "CASE " + " ".join(f"WHEN l_returnflag = '{a}' AND l_linestatus = '{b}' THEN '{g}'" for (a, b), g in GROUP_OF.items()) + " END"
SCHOOL_YEAR_SQL = "year(l_shipdate) || '-' || lpad(CAST((year(l_shipdate) + 1) % 100 AS VARCHAR), 2, '0')"


def school_years(spark, folder):
    """The school years in which lines were shipped."""
    years = line_timepoints(spark, folder).select("school_year").distinct().collect()
    return sorted(f"{r.school_year}-{(int(r.school_year) + 1) % 100:02d}" for r in years)


@query("lake_roundtrip", f"""
WITH c AS ({sql_counts({'entity_id': 'l_suppkey', 'school_year': SCHOOL_YEAR_SQL, 'label': LABEL_CASE}, SUPPLY_LEVEL, 5, 'lineitem')})
SELECT entity_id, school_year, 'BoSY' AS period, split_part(label, ' ', 1) AS grade, nullif(split_part(label, ' ', 2), '') AS lang,
  c1, c2, c3, c4, c5, 'Name ' || entity_id || ' ñ' AS name FROM c""")
def lake_roundtrip(spark, folder):
    """Dirty exports of every year: newest one found, headers and text repaired, counts stored and read back."""
    lines = table(spark, folder, "lineitem")
    label = F.expr(LABEL_CASE)
    year = F.year("l_shipdate")
    school_year = F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))
    counts = records_to_counts(
        lines, [F.col("l_suppkey").alias("entity_id"), school_year.alias("school_year"), label.alias("label")],
        F.ceil(F.col("l_quantity") / 10), 5,
    ).withColumns({"grade": F.split_part("label", F.lit(" "), F.lit(1)), "lang": F.nullif(F.split_part("label", F.lit(" "), F.lit(2)), F.lit(""))})
    wide = materialise(long_to_wide(counts, ["entity_id", "school_year"], EARLY_READING.groups, READING_5))
    root = scratch(spark)
    data = [f"{g.label} {level}" for g in EARLY_READING.groups for level in READING_5.levels]
    name = F.concat(F.lit("Name "), F.col("entity_id").cast("string"), F.lit(" ¤ "))

    def columns(df, factor):
        head = [("School ID", F.format_number("entity_id", 0)), ("School Name", name), ("Region", F.lit("BARMM "))]
        body = [(c.replace("Fil Higher", "FIl Higher"), number_text(F.col(f"`{c}`") * factor)) for c in data]
        return [*head, *reversed(body), ("G1 Total Assessed", F.lit("1"))]

    for sy in school_years(spark, folder):
        one_year = wide.filter(F.col("school_year") == sy)
        write_export(one_year, f"{root}/in/SALES_BoSY_{sy}_20240101_000000.csv", columns(one_year, 3))
        write_export(one_year, f"{root}/in/SALES_BoSY_{sy}_20240601_120000.csv", columns(one_year, 1))
    found = discovery.latest_exports(discovery.list_files(spark, f"{root}/in", "*.csv"), "SALES")
    loaded = bronze.load_all_early_reading(spark, discovery.file_map(found))
    lake.write_partitioned(bronze.early_reading_counts(loaded), f"{root}/silver/counts")
    lake.write_partitioned(bronze.entity_rows(loaded, EARLY_READING.name), f"{root}/silver/entities")
    keys = ["entity_id", "school_year", "period"]
    stored = lake.read_partitioned(spark, f"{root}/silver/counts", EARLY_READING.name)
    entities = lake.read_partitioned(spark, f"{root}/silver/entities", EARLY_READING.name).select(*keys, "name")
    rows = stored.join(entities, keys).select(
        *keys, "grade", "lang", *[c.alias(f"c{i}") for i, c in enumerate(levels("counts", 5), 1)], "name"
    )
    return rows.filter(F.col("c1").isNotNull())


UPPER_CASE = "CASE o_orderstatus WHEN 'F' THEN 'G7 Fil' WHEN 'O' THEN 'G7 Eng' ELSE 'G9 Fil' END"
UPPER_YEAR = "CASE WHEN year(o_orderdate) <= 1998 THEN '2024-25' ELSE '2025-26' END"


@query("upper_reading_roundtrip", f"""
WITH c AS ({sql_counts({'entity_id': 'o_custkey', 'school_year': UPPER_YEAR, 'label': UPPER_CASE}, SQL_WEEKDAY, 7, 'orders')})
SELECT entity_id, school_year, split_part(label, ' ', 1) AS grade, split_part(label, ' ', 2) AS lang,
  {', '.join(f'c{i}' for i in range(1, 8))}, c1 + c2 + c3 + c4 + c5 + c6 + c7 AS assessed FROM c""")
def upper_reading_roundtrip(spark, folder):
    """Level names in the other order; files found by pattern; 7-level counts and assessed columns read back."""
    orders = table(spark, folder, "orders")
    label = F.expr(UPPER_CASE)
    counts = records_to_counts(
        orders, [F.col("o_custkey").alias("entity_id"), F.expr(UPPER_YEAR).alias("school_year"), label.alias("label")],
        weekday_level(), 7,
    ).withColumns({"grade": F.split_part("label", F.lit(" "), F.lit(1)), "lang": F.split_part("label", F.lit(" "), F.lit(2))})
    groups = upper_reading("ks3").groups
    wide = materialise(long_to_wide(counts, ["entity_id", "school_year"], groups, READING_7))
    root = scratch(spark)

    def export_name(g, level):
        depth, _, severity = level.partition(" ")
        return f"{g.label} {level}" if depth not in ("2LD", "3LD") else f"{g.label} {severity} {depth[0]}Level"

    def columns():
        out = [("Region", F.lit("R")), ("School ID", F.col("entity_id").cast("string")), ("School Name", F.lit("x"))]
        for g in groups:
            cells = [F.col(f"`{g.label} {level}`") for level in READING_7.levels]
            total = cells[0]
            for c in cells[1:]:
                total = total + c
            out.append((f"{g.label} Assessed", number_text(total)))
            out += [(export_name(g, level), number_text(c)) for level, c in zip(READING_7.levels, cells, strict=True)]
        return out

    files = {"2024-25": "Results Archive Secondary BoSY.csv", "2025-26": "Dashboard KS3 BoSY.csv"}
    for sy, file in files.items():
        write_export(wide.filter(F.col("school_year") == sy), f"{root}/in/{file}", columns())
    found = discovery.registered_exports(
        discovery.list_files(spark, f"{root}/in", "part-*"), discovery.UPPER_READING_PATTERNS
    )
    frames = [bronze.load_upper_reading(spark, path, *key) for key, path in discovery.file_map(found).items()]
    loaded = bronze.union_all(frames)
    lake.write_partitioned(bronze.upper_reading_counts(loaded, "ks3", READING_7), f"{root}/silver")
    keys = ["entity_id", "school_year", "period"]
    stored = lake.read_partitioned(spark, f"{root}/silver", "upper_reading", "ks3", [(y, "BoSY") for y in files])
    joined = stored.join(bronze.assessed_counts(loaded, "ks3"), [*keys, "grade", "lang"])
    return joined.filter(F.col("assessed").isNotNull()).select(
        "entity_id", "school_year", "grade", "lang", *[c.alias(f"c{i}") for i, c in enumerate(levels("counts", 7), 1)],
        "assessed",
    )


MATH_CASE = "CASE o_orderstatus WHEN 'F' THEN 'G1' WHEN 'O' THEN 'G2' ELSE 'G3' END"
PERIOD_SQL = "CASE WHEN month(o_orderdate) <= 6 THEN 'BoSY' ELSE 'EoSY' END"


@query("mathematics_roundtrip", f"""
WITH c AS ({sql_counts({'entity_id': 'o_custkey', 'period': PERIOD_SQL, 'grade': MATH_CASE}, source='orders')})
SELECT entity_id, period, grade, c1, c2, c3, c4, c5, 'town' AS district FROM c""")
def mathematics_roundtrip(spark, folder):
    """Municipality instead of district, several files per pattern, padded text."""
    counts = customer_counts(spark, folder, {"period": order_period(), "grade": F.expr(MATH_CASE)})
    counts = counts.withColumn("lang", F.lit(None).cast("string"))
    groups = mathematics("ks1").groups
    wide = materialise(long_to_wide(counts, ["entity_id", "period"], groups, MATH_5))
    root = scratch(spark)

    def columns(factor):
        cells = [f"{g.label} {level}" for g in groups for level in MATH_5.levels]
        return [
            ("School ID", F.concat(F.col("entity_id").cast("string"), F.lit(".0"))), ("Municipality", F.lit("town ")),
            ("Total Assessed", F.lit("1")), *[(c, F.concat(F.lit(" "), number_text(F.col(f"`{c}`") * factor))) for c in cells],
        ]

    for period in ("BoSY", "EoSY"):
        part = wide.filter(F.col("period") == period)
        write_export(part, f"{root}/in/Dashboard (KS1) {period} 1.csv", columns(2))
        write_export(part, f"{root}/in/Dashboard (KS1) {period} 2.csv", columns(1))
    found = discovery.registered_exports(
        discovery.list_files(spark, f"{root}/in", "part-*"), discovery.MATHEMATICS_PATTERNS
    )
    loaded = bronze.union_all([
        bronze.load_mathematics(spark, path, *key) for key, path in discovery.file_map(found).items()
    ])
    lake.write_partitioned(bronze.mathematics_counts(loaded, "ks1"), f"{root}/silver")
    keys = ["entity_id", "school_year", "period"]
    entities = bronze.entity_rows(loaded, "mathematics", "ks1").select(*keys, "district")
    stored = lake.read_partitioned(spark, f"{root}/silver", "mathematics", "ks1").join(entities, keys)
    return stored.select(
        "entity_id", "period", "grade", *[c.alias(f"c{i}") for i, c in enumerate(levels("counts", 5), 1)], "district"
    ).filter(F.col("c1").isNotNull())


QUARANTINE_KEYS = {"entity_id": "o_custkey", "period": PERIOD_SQL, "grade": MATH_CASE}


@query("quarantine_roundtrip", f"""
WITH c AS ({sql_counts(QUARANTINE_KEYS, source='orders')})
SELECT 'bad_key' AS reason, period, 'x' || entity_id AS raw_id, NULL::BIGINT AS entity_id, NULL AS grade, NULL::DOUBLE AS first_count,
  'town' AS district, 1::BIGINT AS "rows" FROM (SELECT DISTINCT entity_id, period FROM c WHERE entity_id % 10 = 0)
UNION ALL SELECT 'negative_count', period, NULL, entity_id, grade, 0.0 - c1, NULL, 1 FROM c WHERE entity_id % 10 = 1 AND grade = 'G1'
UNION ALL SELECT 'load', period, NULL, NULL, NULL, NULL, NULL, count(DISTINCT entity_id) FROM c GROUP BY period""")
def quarantine_roundtrip(spark, folder):
    """Keys that are no numbers and negative groups of a load, read back from the quarantine of the lake."""
    counts = customer_counts(spark, folder, {"period": order_period(), "grade": F.expr(MATH_CASE)}).withColumn("lang", F.lit(None).cast("string"))
    groups = mathematics("ks1").groups
    wide = materialise(long_to_wide(counts, ["entity_id", "period"], groups, MATH_5))
    root = scratch(spark)
    number = F.col("entity_id")
    key = F.when(number % 10 == 0, F.concat(F.lit("x"), number.cast("string"))).otherwise(number.cast("string"))

    def cell(g, level):
        value = F.col(f"`{g.label} {level}`")
        return number_text(F.when((number % 10 == 1) & F.lit(g.grade == "G1"), -value).otherwise(value))

    cells = [(f"{g.label} {level}", cell(g, level)) for g in groups for level in MATH_5.levels]
    for period in ("BoSY", "EoSY"):
        head = [("School ID", key), ("Municipality", F.lit("town "))]
        write_export(wide.filter(F.col("period") == period), f"{root}/in/Dashboard (KS1) {period} 1.csv", [*head, *cells])
    loads = pipeline.load_mathematics(spark, f"{root}/in", f"{root}/lake")
    kept = sum(load.accepted for load in loads)
    stored = pipeline.lake_table(spark, f"{root}/lake", "entities", "mathematics", "ks1").count()
    if stored != kept or sum(load.read for load in loads) != wide.count():
        raise ValueError("rows of the load are missing")
    found = pipeline.lake_table(spark, f"{root}/lake", "quarantine", "mathematics", "ks1")
    return found.select(
        "reason", "period", "raw_id", "entity_id", "grade", (F.get("counts", F.lit(0)) + F.lit(0.0)).alias("first_count"),
        F.try_element_at("cells", F.lit("District")).alias("district"), "rows",
    )


# One end of a year is missing, so the years behind it move up by one.
MATHS_SOURCE = f"orders WHERE NOT (year(o_orderdate) = 1996 AND {PERIOD_SQL} = 'EoSY')"
MATHS_TP = {"entity_id": "o_custkey", "tp": f"concat_ws(' ', {PERIOD_SQL}, {SQL_YEAR})", "grade": MATH_CASE}
MATHS_MOMENTS = (
    f"base AS ({sql_counts(MATHS_TP, source=MATHS_SOURCE)}), shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})"
)


def maths_tables(spark, folder):
    """Tables of mathematics from a lake of orders, written and read back."""
    gone = (F.year("o_orderdate") == 1996) & (order_period() == "EoSY")
    orders = table(spark, folder, "orders").where(~gone)
    keys = [F.col("o_custkey").alias("entity_id"), order_year().alias("school_year"), order_period().alias("period")]
    tags = [F.lit("mathematics").alias("instrument"), F.lit("ks1").alias("ks")]
    counts = records_to_counts(orders, [*keys, F.expr(MATH_CASE).alias("grade")], priority_level(), 5)
    entities = orders.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("reported_total"))
    name = F.concat(F.lit("Name "), F.col("entity_id").cast("string")).alias("name")
    places = [F.lit(x).cast("string").alias(c) for c, x in (("region", "R"), ("division", None), ("district", "D"))]
    root = scratch(spark)
    by = (*lake.PARTITIONS, "ks")
    none = F.lit(None).cast("string").alias("lang")
    lake.write_partitioned(counts.select("entity_id", "grade", none, "counts", "school_year", "period", *tags), f"{root}/lake/counts", by)
    lake.write_partitioned(entities.select("entity_id", name, *places, "reported_total", "school_year", "period", *tags), f"{root}/lake/entities", by)
    written = pipeline.write_tables(pipeline.mathematics_tables(spark, f"{root}/lake", "ks1"), f"{root}/gold", "mathematics_ks1")
    return [spark.read.parquet(path) for path in written]


MOMENT_OUT = ", ".join(r(f"avg({m})", m) for m in ("ordinal_mean", "ordinal_sd", "ordinal_skew", "ordinal_kurt", "bimodality_coef"))


@query("maths_timepoints", f"""WITH {MATHS_MOMENTS}
SELECT entity_id, split_part(tp, ' ', 2) AS school_year, split_part(tp, ' ', 1) AS period, count(p1) AS groups_with_data, {MOMENT_OUT},
  {r('avg(p5)', 'pct_aglhp')}, sum(s) AS total_assessed, tp AS timepoint_label, 'Name ' || entity_id AS name, 'R' AS region,
  NULL AS division, 'D' AS district, 'ks1' AS ks FROM moments GROUP BY entity_id, tp""")
def maths_timepoints(spark, folder):
    return rounded(maths_tables(spark, folder)[0])


@query("maths_segments", f"""
WITH {MATHS_MOMENTS}, {sql_learning(f"(SELECT * FROM {MATHS_SOURCE})", SQL_YEAR, PERIOD_SQL)}, {sql_changes(5)} {CHANGES_OUT.replace(' FROM changes', ", 'ks1' AS ks FROM changes")}""")
def maths_segments(spark, folder):
    """Begin to end of each year that has both, numbered without gaps."""
    return rounded(maths_tables(spark, folder)[1])


@query("partition_overwrite", f"""
WITH c AS ({sql_counts({'entity_id': 'CAST(c_nationkey AS BIGINT)', 'school_year': SQL_YEAR, 'period': PERIOD_SQL, 'grade': 'c_mktsegment'})})
SELECT entity_id, school_year, period, grade, CASE WHEN school_year = '1998' AND period = 'EoSY' THEN 2 * c1 ELSE c1 END AS c1 FROM c""")
def partition_overwrite(spark, folder):
    """A second write of one timepoint replaces that timepoint and nothing else."""
    counts = materialise(sales_counts(spark, folder).withColumn("instrument", F.lit("sales")))
    path = f"{scratch(spark)}/counts"
    lake.write_partitioned(counts, path)
    again = counts.filter((F.col("school_year") == "1998") & (F.col("period") == "EoSY"))
    doubled = again.withColumn("counts", F.transform("counts", lambda c: c * 2))
    lake.write_partitioned(doubled, path)
    stored = lake.read_partitioned(spark, path, "sales")
    return stored.select("entity_id", "school_year", "period", "grade", F.get("counts", F.lit(0)).alias("c1"))


@query("area_funds_positional", """
SELECT r_name AS region, n_name AS province, s_name AS area,
  CASE WHEN s_acctbal > 3000 THEN 'City' ELSE 'Municipality' END AS area_type,
  s_acctbal AS rpt_special_education_fund, CAST(s_suppkey AS DOUBLE) AS total_current_operating_expenditure
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE s_acctbal > 0""")
def area_funds_positional(spark, folder):
    """A fund table without usable header: columns by position, rows by type."""
    nations = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, folder, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    kind = F.when(F.col("s_acctbal") > 3000, "City").when(F.col("s_acctbal") > 0, "Municipality").otherwise("Total")
    cells = {
        1: F.col("r_name"), 2: F.col("n_name"), 3: F.col("s_name"), 4: kind,
        6: F.format_number("s_acctbal", 2), 32: F.col("s_suppkey").cast("string"),
    }
    path = f"{scratch(spark)}/funds.csv"
    write_export(rows, path, [(f"x{i}", cells.get(i, F.lit("-"))) for i in range(33)])
    return bronze.load_area_funds(spark, path).select(
        "region", "province", "area", "area_type", "rpt_special_education_fund", "total_current_operating_expenditure"
    )


@query("school_areas", """
SELECT c_custkey AS entity_id, c_mktsegment AS "Region", 'd' AS "Division", 'MIMAROPA Region' AS psgc_region,
  n_name AS psgc_province, CAST(c_nationkey AS VARCHAR) AS area_code, 'City of ' || n_name AS area_name
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 0""")
def school_areas(spark, folder):
    """School database: columns by name, rows without a numeric key dropped."""
    rows = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.when(F.col("c_acctbal") < 0, "no id").otherwise(F.col("c_custkey").cast("string"))
    cells = {
        "Unused": F.lit("u"), "BEIS School ID": key, "Region": F.col("c_mktsegment"), "Division": F.lit("d"),
        "(PSGC) REGION NAME": F.lit("MIMAROPA Region"), "(PSGC) PROVINCE NAME": F.col("n_name"),
        "(PSGC) MUNCIPAL/CITY": F.col("c_nationkey").cast("string"),
        "(PSGC) MUNCIPAL/CITY NAME": F.concat(F.lit("City of "), F.col("n_name")),
    }
    path = f"{scratch(spark)}/schools.csv"
    write_export(rows, path, list(cells.items()))
    return bronze.load_school_areas(spark, path, header_row=0)


@query("id_list", "SELECT DISTINCT user_id AS entity_id FROM events WHERE event_type <> 'view'")
def id_list(spark, folder):
    """A list of keys as text lines, with blank lines in between."""
    events = table(spark, folder, "events")
    lines = events.select(F.when(F.col("event_type") == "view", "  ").otherwise(F.col("user_id").cast("string")).alias("value"))
    path = f"{scratch(spark)}/ids.txt"
    lines.write.text(path)
    return bronze.load_id_list(spark, path)
