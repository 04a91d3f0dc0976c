"""Discovery, typing and alignment of exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import to_key, to_number
from ..sources.bronze import enrolled, union_all
from ..sources.discovery import UPPER_READING_PATTERNS, latest_exports, missing_exports, registered_exports
from .registry import query, table

NAME_SQL = """'lake/in/SALES_' || CASE WHEN month(o_orderdate) <= 6 THEN 'BoSY' ELSE 'EoSY' END || '_' || year(o_orderdate)
  || '-' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') || '_'
  || CASE WHEN o_orderstatus = 'P' THEN 'draft' ELSE strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0') END || '.csv'"""


def export_names(spark, folder):
    """One export name per order; those in progress have no time stamp."""
    orders = table(spark, folder, "orders")
    year = F.year("o_orderdate")
    stamp = F.concat(
        F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.lpad((F.col("o_orderkey") % 240000).cast("string"), 6, "0")
    )
    return orders.select(F.concat(
        F.lit("lake/in/SALES_"),
        F.when(F.month("o_orderdate") <= 6, "BoSY").otherwise("EoSY"),
        F.lit("_"),
        year.cast("string"),
        F.lit("-"),
        F.lpad(((year + 1) % 100).cast("string"), 2, "0"),
        F.lit("_"),
        F.when(F.col("o_orderstatus") == "P", "draft").otherwise(stamp),
        F.lit(".csv"),
    ).alias("path"))


@query("latest_export", f"""
WITH n AS (SELECT {NAME_SQL} AS path FROM orders),
p AS (SELECT path, regexp_extract(path, 'SALES_(\\w+)_(\\d{{4}}-\\d{{2}})_(\\d{{8}}_\\d{{6}})\\.csv$', 2) AS school_year,
  regexp_extract(path, 'SALES_(\\w+)_(\\d{{4}}-\\d{{2}})_(\\d{{8}}_\\d{{6}})\\.csv$', 1) AS period,
  regexp_extract(path, 'SALES_(\\w+)_(\\d{{4}}-\\d{{2}})_(\\d{{8}}_\\d{{6}})\\.csv$', 3) AS stamp FROM n)
SELECT school_year, period, arg_max(path, stamp) AS path FROM p WHERE stamp <> '' GROUP BY 1, 2""")
def latest_export(spark, folder):
    return latest_exports(export_names(spark, folder), "SALES")


REGISTERED_NAME = """'in/' || CASE WHEN o_orderstatus = 'F' THEN 'Results Archive Elementary' WHEN o_orderstatus = 'O'
  THEN 'Dashboard KS3' ELSE 'Notes' END || ' ' || o_orderpriority || ' ' ||
  CASE WHEN o_totalprice > 200000 THEN 'BoSY' ELSE 'EoSY' END || ' ' || o_orderkey || '.csv'"""


@query("registered_export", f"""
WITH n AS (SELECT {REGISTERED_NAME} AS path FROM orders),
k AS (SELECT path, CASE WHEN path LIKE '%Elementary%' THEN 'ks2' ELSE 'ks3' END AS ks,
  CASE WHEN path LIKE '%Archive%' THEN '2024-25' ELSE '2025-26' END AS school_year,
  CASE WHEN path LIKE '%BoSY%' THEN 'BoSY' ELSE 'EoSY' END AS period FROM n WHERE path NOT LIKE '%Notes%')
SELECT ks, school_year, period, max(path) AS path, 'found' AS status FROM k GROUP BY 1, 2, 3
UNION ALL SELECT ks, school_year, period, NULL, 'missing' FROM (VALUES ('ks2', '2025-26', 'BoSY'), ('ks2', '2025-26', 'EoSY'),
  ('ks3', '2024-25', 'BoSY'), ('ks3', '2024-25', 'EoSY')) AS v(ks, school_year, period)""")
def registered_export(spark, folder):
    """Last file in name order per registered pattern, and the patterns without one."""
    paths = table(spark, folder, "orders").select(F.expr(REGISTERED_NAME).alias("path"))
    found = registered_exports(paths, UPPER_READING_PATTERNS)
    missing = missing_exports(found, UPPER_READING_PATTERNS)
    return found.withColumn("status", F.lit("found")).unionByName(
        missing.withColumns({"path": F.lit(None).cast("string"), "status": F.lit("missing")})
    )


@query("numeric_clean", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS customer FROM orders""")
def numeric_clean(spark, folder):
    """Prices with thousands separators, dashes, percent signs and the text nan; keys with decimals and commas."""
    orders = table(spark, folder, "orders")
    price = F.format_number("o_totalprice", 2)
    dirty_price = (
        F.when(F.col("o_orderstatus") == "P", "-")
        .when(F.col("o_orderpriority") == "5-LOW", F.when(F.col("o_totalprice") > 200000, "nan").otherwise(F.concat(price, F.lit("%"))))
        .otherwise(F.concat(F.lit(" "), price))
    )
    dirty_key = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/a"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.format_number("o_custkey", 0))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
    )
    return orders.select("o_orderkey", to_number(dirty_price).alias("price"), to_key(dirty_key).alias("customer"))


@query("schema_align", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderstatus = 'F' THEN '2024-25' ELSE '2025-26' END AS school_year FROM orders""")
def schema_align(spark, folder):
    """Two exports with different columns in one table, each tagged."""
    orders = table(spark, folder, "orders")
    first = orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    second = orders.filter(F.col("o_orderstatus") != "F").select("o_orderpriority", "o_custkey", "o_orderkey")
    return union_all([
        first.withColumn("school_year", F.lit("2024-25")), second.withColumn("school_year", F.lit("2025-26"))
    ])


@query("enrollment_sum", """
SELECT o_custkey AS entity_id, CAST(count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS DOUBLE) AS enrolled
FROM orders GROUP BY o_custkey""")
def enrollment_sum(spark, folder):
    """Row-wise sum of the columns by sex; other columns are left out."""
    wide = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("school_id")).agg(
        F.nullif(F.count_if(F.col("o_orderstatus") == "F"), F.lit(0)).alias("g1_male"),
        F.nullif(F.count_if(F.col("o_orderstatus") == "O"), F.lit(0)).alias("g1_female"),
        F.count_if(F.col("o_orderstatus") == "P").alias("g1_total"),
    )
    return enrolled(wide, "school_id")
