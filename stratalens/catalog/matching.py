"""Names, crosswalk and area matching.

For the exact rules suppliers are areas, nations provinces and world regions
regions.  For similarity the parts play these roles: brand, type and name; their
distinct names are few, however many parts there are.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.text import place_name, region_short, repaired
from ..operators.matching import (
    area_candidates,
    exact_matches,
    join_funds,
    match_areas,
    matched,
    normalised,
    unmatched,
)
from .registry import query, r, rounded, table


def sql_place(x: str) -> str:
    """Place-name normalisation in SQL; ``x`` is an expression."""
    lowered = f"lower(trim(coalesce({x}, '')))"
    ascii_n = f"replace(replace(replace({lowered}, 'ñ', 'n'), '¤', 'n'), 'ã±', 'n')"
    head = f"trim(split_part({ascii_n}, '(', 1))"
    bare = f"regexp_replace(regexp_replace({head}, '^city of ', ''), '^municipality of ', '')"
    return f"trim(regexp_replace({bare}, ' city$', ''))"


DIRTY_NAME = "CASE p_size % 6 WHEN 0 THEN 'City of ' || upper(p_name) WHEN 1 THEN ' ' || p_name || ' City (Capital) ' " \
    "WHEN 2 THEN 'Municipality of ' || p_name || 'ñ' WHEN 3 THEN p_name || '¤' WHEN 4 THEN p_name || 'Ã±' ELSE NULL END"
DIRTY_REGION = "CASE p_size % 3 WHEN 0 THEN ' MIMAROPA Region ' WHEN 1 THEN 'CARAGA' ELSE p_type END"


@query("name_normalise", f"""
WITH d AS (SELECT p_partkey, {DIRTY_NAME} AS dirty, {DIRTY_REGION} AS region FROM part)
SELECT p_partkey, {sql_place('dirty')} AS place,
  CASE trim(region) WHEN 'MIMAROPA Region' THEN 'MIMAROPA' WHEN 'CARAGA' THEN 'Region XIII' ELSE trim(region) END AS region,
  replace(replace(trim(dirty), 'Ã±', 'ñ'), '¤', 'ñ') AS repaired FROM d""")
def name_normalise(spark, folder):
    """Dirty spellings of every part name, cleaned."""
    parts = table(spark, folder, "part").select(
        "p_partkey", F.expr(DIRTY_NAME).alias("dirty"), F.expr(DIRTY_REGION).alias("region")
    )
    return parts.select(
        "p_partkey",
        place_name(F.col("dirty")).alias("place"),
        region_short(F.col("region")).alias("region"),
        repaired(F.col("dirty")).alias("repaired"),
    )


SUPPLIER_FROM = re.compile(r"\b(FROM|JOIN) (supplier|nation|region)\b")
SUPPLIER_AREAS = """SELECT s_suppkey AS area_code, s_name AS area_name, r_name AS region,
  CASE WHEN s_acctbal < 2000 THEN s_name ELSE n_name END AS province
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""
SUPPLIER_TARGETS = """SELECT s_suppkey, CASE WHEN s_acctbal > 7000 THEN 'ELSEWHERE' ELSE r_name END AS region,
  n_name AS province, CASE WHEN s_acctbal BETWEEN 4000 AND 5000 THEN s_name || ' of nowhere' ELSE s_name END AS name
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""


def supplier_view(spark, folder, text):
    """A query over supplier, nation and region; the tables are passed in, not registered for the session."""
    names = ("supplier", "nation", "region")
    return spark.sql(SUPPLIER_FROM.sub(lambda m: f"{m[1]} {{{m[2]}}}", text), **{n: table(spark, folder, n) for n in names})


@query("exact_cascade", f"""
WITH c AS (SELECT DISTINCT area_code, area_name, region AS r, lower(province) AS p, lower(area_name) AS n FROM ({SUPPLIER_AREAS})),
t AS (SELECT s_suppkey, region AS r, lower(province) AS p, lower(name) AS n FROM ({SUPPLIER_TARGETS})),
c2 AS (SELECT p, n, min(area_code) AS code FROM c GROUP BY p, n HAVING count(*) = 1),
c3 AS (SELECT n, min(area_code) AS code FROM c WHERE p = n GROUP BY n HAVING count(*) = 1),
c4 AS (SELECT n, min(area_code) AS code FROM c GROUP BY n HAVING count(*) = 1)
SELECT s_suppkey, coalesce(c.area_code, c2.code, c3.code, c4.code) AS area_code,
  CASE WHEN c.area_code IS NOT NULL THEN 'exact' WHEN c2.code IS NOT NULL THEN 'exact_cross_region'
    WHEN c3.code IS NOT NULL OR c4.code IS NOT NULL THEN 'independent_city' END AS match_type
FROM t LEFT JOIN c ON c.r = t.r AND c.p = t.p AND c.n = t.n LEFT JOIN c2 ON c2.p = t.p AND c2.n = t.n
LEFT JOIN c3 ON c3.n = t.n LEFT JOIN c4 ON c4.n = t.n""")
def exact_cascade(spark, folder):
    areas = normalised(supplier_view(spark, folder, SUPPLIER_AREAS), "region", "province", "area_name")
    targets = normalised(supplier_view(spark, folder, SUPPLIER_TARGETS), "region", "province", "name")
    found = exact_matches(targets.select("s_suppkey", "region_norm", "province_norm", "name_norm"), area_candidates(areas))
    return found.select("s_suppkey", F.col("exact_code").alias("area_code"), F.col("exact_kind").alias("match_type"))


PART_NAME = "CASE WHEN p_size <= 20 THEN p_name WHEN p_size <= 35 THEN replace(p_name, 'e', '') ELSE 'zz' || p_name || 'qqq' END"
PART_FUNDS = f"""SELECT p_partkey, p_brand AS region, p_type AS province, {PART_NAME} AS area,
  CASE WHEN p_size > 45 THEN 'Province' WHEN p_retailprice > 1500 THEN 'City' ELSE 'Municipality' END AS area_type,
  p_retailprice AS fund FROM part"""


FUZZY_SQL = f"""
c AS (SELECT p_brand AS r, lower(p_type) AS p, p_name AS n, min(p_partkey) AS code FROM part GROUP BY 1, 2, 3),
f AS (SELECT p_partkey, region AS r, lower(province) AS p, area AS n FROM ({PART_FUNDS}) WHERE area_type <> 'Province'),
c2 AS (SELECT p, n, min(code) AS code FROM c GROUP BY p, n HAVING count(*) = 1),
c3 AS (SELECT n, min(code) AS code FROM c WHERE p = n GROUP BY n HAVING count(*) = 1),
c4 AS (SELECT n, min(code) AS code FROM c GROUP BY n HAVING count(*) = 1),
e AS (SELECT t.r, t.p, t.n, coalesce(c.code, c2.code, c3.code, c4.code) AS code,
  CASE WHEN c.code IS NOT NULL THEN 'exact' WHEN c2.code IS NOT NULL THEN 'exact_cross_region'
    WHEN c3.code IS NOT NULL OR c4.code IS NOT NULL THEN 'independent_city' END AS kind
  FROM (SELECT DISTINCT r, p, n FROM f) t LEFT JOIN c ON c.r = t.r AND c.p = t.p AND c.n = t.n
  LEFT JOIN c2 ON c2.p = t.p AND c2.n = t.n LEFT JOIN c3 ON c3.n = t.n LEFT JOIN c4 ON c4.n = t.n),
names AS (SELECT a, b, 1 - levenshtein(a, b) / greatest(length(a), length(b)) AS ratio
  FROM (SELECT DISTINCT n AS a FROM e WHERE kind IS NULL), (SELECT DISTINCT n AS b FROM c)),
x AS (SELECT e.r, e.p, e.n, ratio, b, c.code, c.r = e.r AS sr, c.p = e.p AS sp
  FROM e JOIN names ON a = e.n JOIN c ON c.n = b AND (c.r = e.r OR c.p = e.p) WHERE e.kind IS NULL),
rp AS (SELECT r, p, n, ratio, b, code FROM (SELECT *, row_number() OVER (PARTITION BY r, p, n ORDER BY ratio DESC, b, code) AS k
  FROM x WHERE sr AND sp) WHERE k = 1),
po AS (SELECT r, p, n, ratio, b, code FROM (SELECT *, row_number() OVER (PARTITION BY r, p, n ORDER BY ratio DESC, b, code) AS k
  FROM x WHERE sp) WHERE k = 1),
ro AS (SELECT r, p, n, ratio, b, code FROM (SELECT *, row_number() OVER (PARTITION BY r, p, n ORDER BY ratio DESC, b, code) AS k
  FROM x WHERE sr) WHERE k = 1),
m AS (SELECT e.r, e.p, e.n,
  CASE WHEN e.kind IS NOT NULL THEN e.kind WHEN rp.ratio >= 0.8 THEN 'fuzzy_region+province'
    WHEN po.ratio >= 0.8 THEN 'fuzzy_province_only' WHEN ro.ratio >= 0.8 THEN 'fuzzy_region_only' ELSE 'unmatched' END AS match_type,
  CASE WHEN e.kind IS NOT NULL THEN e.code WHEN rp.ratio >= 0.8 THEN rp.code WHEN po.ratio >= 0.8 THEN po.code
    WHEN ro.ratio >= 0.8 THEN ro.code END AS area_code,
  CASE WHEN e.kind IS NOT NULL THEN e.n WHEN rp.ratio >= 0.8 THEN rp.b WHEN po.ratio >= 0.8 THEN po.b
    ELSE coalesce(ro.b, '') END AS matched_to,
  CASE WHEN e.kind IS NOT NULL THEN 1.0 WHEN rp.ratio >= 0.8 THEN rp.ratio WHEN po.ratio >= 0.8 THEN po.ratio
    ELSE coalesce(ro.ratio, 0) END AS similarity
  FROM e LEFT JOIN rp USING (r, p, n) LEFT JOIN po USING (r, p, n) LEFT JOIN ro USING (r, p, n)),
log AS (SELECT p_partkey, match_type, area_code, matched_to, similarity FROM f JOIN m USING (r, p, n))"""


def part_crosswalk(spark, folder):
    parts = table(spark, folder, "part")
    areas = parts.select(
        F.col("p_partkey").alias("area_code"), F.col("p_name").alias("area_name"), "p_brand", "p_type"
    )
    return normalised(areas, "p_brand", "p_type", "area_name")


def part_funds(spark, folder):
    return spark.sql(PART_FUNDS.replace("FROM part", "FROM {part}"), part=table(spark, folder, "part"))


@query("fuzzy_match", f"""WITH {FUZZY_SQL}
SELECT p_partkey, match_type, area_code, matched_to, {r('similarity', 'similarity')} FROM log""")
def fuzzy_match(spark, folder):
    log = match_areas(part_funds(spark, folder), part_crosswalk(spark, folder))
    return rounded(log.select("p_partkey", "match_type", "area_code", "matched_to", "similarity"))


@query("match_split", f"""WITH {FUZZY_SQL}
SELECT CASE WHEN area_code IS NULL THEN 'unmatched' ELSE 'matched' END AS side, match_type, count(*) AS areas
FROM log GROUP BY 1, 2""")
def match_split(spark, folder):
    log = match_areas(part_funds(spark, folder), part_crosswalk(spark, folder))
    sides = matched(log).withColumn("side", F.lit("matched")).unionByName(
        unmatched(log).withColumn("side", F.lit("unmatched"))
    )
    return sides.groupBy("side", "match_type").agg(F.count(F.lit(1)).alias("areas"))


@query("fuzzy_match_blocks")
def fuzzy_match_blocks(spark, folder):
    """The same with the matching-block ratio, which SQL does not have."""
    log = match_areas(part_funds(spark, folder), part_crosswalk(spark, folder), similarity="blocks")
    return rounded(log.select("p_partkey", "match_type", "area_code", "matched_to", "similarity"))


@query("fund_two_pass", """
WITH m AS (SELECT s_suppkey AS area_code, lower(n_name) AS p, s_name AS area, 'City' AS area_type, s_acctbal AS fund
  FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 3000),
pr AS (SELECT p, area, area_type, fund FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY area) AS k FROM m) WHERE k = 1)
SELECT c_custkey AS entity_id, coalesce(m.area, pr.area) AS fund_area, coalesce(m.area_type, pr.area_type) AS fund_area_type,
  CASE WHEN m.area IS NOT NULL THEN m.fund ELSE pr.fund END AS fund_fund
FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN m ON m.area_code = c_custkey LEFT JOIN pr ON pr.p = lower(n_name)""")
def fund_two_pass(spark, folder):
    """Customers find a supplier fund by their number, else the first of their nation."""
    nations = table(spark, folder, "nation").select("n_nationkey", F.lower("n_name").alias("province_norm"))
    suppliers = table(spark, folder, "supplier").filter(F.col("s_acctbal") > 3000)
    funds = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("area_code"), "province_norm", F.col("s_name").alias("area"),
        F.lit("City").alias("area_type"), F.col("s_acctbal").alias("fund"),
    )
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entity_id"), F.col("c_custkey").alias("area_code"), "province_norm"
    )
    return join_funds(customers, funds, ["fund"]).drop("area_code", "province_norm")
