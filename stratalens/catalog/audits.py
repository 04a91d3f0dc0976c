"""Audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.audit import (
    empty_rows,
    group_total_difference,
    inventory,
    null_profile,
    profile,
    reconcile,
    reconcile_by_buckets,
    share_sum_check,
    validity_summary,
)
from ..functions.distribution import levels
from ..functions.text import to_number
from ..operators.counts import lower_band, records_to_counts
from ..operators.moments import with_shares
from ..operators.validity import validity
from ..sources import lake
from .distributions import SALES_KEYS, STRICT_AT, VALIDITY_SQL
from .registry import (
    SALES,
    SQL_PERIOD,
    SQL_YEAR,
    customer_counts,
    order_period,
    order_year,
    query,
    r,
    rounded,
    sales_counts,
    scratch,
    sql_counts,
    sql_shares,
    table,
)

CUSTOMER_YEAR = {"entity_id": "o_custkey", "yr": SQL_YEAR, "grade": "o_orderstatus"}


def yearly(spark, folder):
    return customer_counts(spark, folder, {"yr": order_year(), "grade": F.col("o_orderstatus")})


@query("share_sum_check", f"""
WITH base AS ({sql_counts(SALES_KEYS)}), shares AS ({sql_shares('base')})
SELECT grade, count(p1) AS with_data, {r('min(p1 + p2 + p3 + p4 + p5)', 'lowest')},
  {r('max(p1 + p2 + p3 + p4 + p5)', 'highest')}, bool_and(abs(p1 + p2 + p3 + p4 + p5 - 100) <= 0.01) AS all_100
FROM shares GROUP BY grade""")
def share_sums(spark, folder):
    return rounded(share_sum_check(with_shares(sales_counts(spark, folder), 5), ["grade"], 5))


@query("validity_summary", f"""
WITH base AS ({sql_counts(SALES_KEYS)}), shares AS ({sql_shares('base')}), flags AS ({VALIDITY_SQL})
SELECT school_year, period, count(*) AS entities, count(*) FILTER (WHERE valid) AS n_valid,
  count(*) FILTER (WHERE valid_strict) AS n_strict, {r('avg(CASE WHEN valid THEN 1.0 ELSE 0.0 END)', 'valid_share')},
  {r('avg(CASE WHEN valid_strict THEN 1.0 ELSE 0.0 END)', 'strict_share')} FROM flags GROUP BY 1, 2""")
def validity_summary_query(spark, folder):
    flags = validity(
        sales_counts(spark, folder), ["entity_id", "school_year", "period"], SALES.groups, 5, min_assessed=STRICT_AT
    )
    return rounded(validity_summary(flags, ["school_year", "period"]))




@query("empty_rows", f"""
WITH base AS ({sql_counts(CUSTOMER_YEAR, source='orders')}),
e AS (SELECT entity_id, yr, bool_or(c1 + c2 > 0) AS any_level, sum(CASE WHEN c1 + c2 > 0 THEN c1 + c3 ELSE 0 END) AS total
  FROM base GROUP BY 1, 2)
SELECT yr, count(*) AS entities, count(*) FILTER (WHERE NOT any_level) AS all_missing,
  count(*) FILTER (WHERE total = 0) AS all_zero FROM e GROUP BY yr""")
def empty_rows_query(spark, folder):
    """Two of the levels, missing where the customer has no urgent or high order."""
    counts = yearly(spark, folder)
    c = levels("counts", 5)
    shown = F.when(c[0] + c[1] > 0, F.array(c[0], c[2])).otherwise(F.array(F.lit(None).cast("double"), F.lit(None).cast("double")))
    return empty_rows(counts.withColumn("counts", shown), ["entity_id"], ["yr"], 2)


@query("lake_inventory", f"""
WITH base AS ({sql_counts(CUSTOMER_YEAR, source='orders')})
SELECT yr, count(*) AS rows, count(DISTINCT entity_id) AS entities,
  CAST(sum(CASE WHEN c1 = 0 THEN 1 ELSE 0 END + CASE WHEN c5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_levels
FROM base GROUP BY yr""")
def lake_inventory(spark, folder):
    counts = yearly(spark, folder)
    c = levels("counts", 5)
    gaps = F.array(F.nullif(c[0], F.lit(0.0)), c[1], c[2], c[3], F.nullif(c[4], F.lit(0.0)))
    return inventory(counts.withColumn("counts", gaps).withColumn("yr", F.col("yr")), ["yr"], 5)




@query("null_profile", """
WITH w AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS p,
  max(CASE WHEN o_orderstatus = 'X' THEN o_totalprice END) AS x FROM orders GROUP BY 1, 2)
SELECT yr, count(*) AS rows, 'p' AS column_name, round(avg(CASE WHEN p IS NULL THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS missing_share,
  count(p) = 0 AS all_missing FROM w GROUP BY yr
UNION ALL SELECT yr, count(*), 'x', round(avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END), 6) + 0.0, count(x) = 0 FROM w GROUP BY yr""")
def null_profile_query(spark, folder):
    wide = table(spark, folder, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice"))).alias("p"),
        F.max(F.when(F.col("o_orderstatus") == "X", F.col("o_totalprice"))).alias("x"),
    )
    return rounded(null_profile(wide, ["p", "x"], ["yr"]))


@query("group_total_difference", f"""
WITH base AS ({sql_counts({'entity_id': 'l_suppkey', 'grade': 'l_returnflag'}, "CAST(ceil(l_quantity / 10) AS INTEGER)", 5, "lineitem WHERE l_discount > 0.01")}),
a AS (SELECT l_suppkey AS entity_id, l_returnflag AS grade, CAST(count(*) AS DOUBLE) AS assessed FROM lineitem GROUP BY 1, 2)
SELECT entity_id, grade, c1 + c2 + c3 + c4 + c5 AS level_sum, assessed, abs(c1 + c2 + c3 + c4 + c5 - assessed) AS difference
FROM base JOIN a USING (entity_id, grade)""")
def group_totals(spark, folder):
    """Level sums of the discounted lines against all lines of a group."""
    lines = table(spark, folder, "lineitem")
    keys = [F.col("l_suppkey").alias("entity_id"), F.col("l_returnflag").alias("grade")]
    counts = records_to_counts(lines.filter(F.col("l_discount") > 0.01), keys, F.ceil(F.col("l_quantity") / 10), 5)
    assessed = lines.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("assessed"))
    return group_total_difference(counts, assessed, ["entity_id", "grade"], 5)


@query("reconcile", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS left_price, o_totalprice AS right_price,
  CASE WHEN o_orderstatus = 'P' THEN 'differs' END AS status FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, NULL, o_totalprice, 'only_right' FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'""")
def reconcile_query(spark, folder):
    """A formatted copy against the original; only differences stay."""
    orders = table(spark, folder, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.format_number("o_totalprice", 2))
    copy = orders.filter((F.col("o_orderpriority") != "1-URGENT") | (F.col("o_orderstatus") == "P")).select(
        "o_orderkey", to_number(text).alias("price")
    )
    return reconcile(copy, orders.select("o_orderkey", F.col("o_totalprice").alias("price")), ["o_orderkey"], ["price"])


@query("reconcile_checksums", """
SELECT o_orderkey, o_totalprice AS left_price, CASE WHEN o_orderkey % 100 = 7 THEN o_totalprice + 1 END AS right_price,
  o_orderstatus AS left_status, CASE WHEN o_orderkey % 100 = 7 THEN o_orderstatus END AS right_status,
  CASE WHEN o_orderkey % 100 = 7 THEN 'differs' ELSE 'only_left' END AS status FROM orders WHERE o_orderkey % 100 IN (7, 11)""")
def reconcile_checksums(spark, folder):
    """All orders against a copy in which some differ and some are missing: checksums first, then rows of buckets that differ."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    changed = F.when(F.col("o_orderkey") % 100 == 7, F.col("price") + 1).otherwise(F.col("price"))
    copy = orders.where(F.col("o_orderkey") % 100 != 11).withColumn("price", changed)
    found = reconcile_by_buckets(orders.withColumnRenamed("status", "state"), copy.withColumnRenamed("status", "state"), ["o_orderkey"], ["price", "state"])
    return found.withColumnsRenamed({"left_state": "left_status", "right_state": "right_status"})


@query("lake_lookup", f"""
WITH c AS ({sql_counts({'entity_id': 'o_custkey', 'school_year': SQL_YEAR, 'period': SQL_PERIOD, 'grade': 'o_orderstatus'}, source='orders')}),
k AS (SELECT c_custkey FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal ORDER BY c_acctbal DESC, c_custkey LIMIT 1)
SELECT entity_id, school_year, period, grade, c1, c2, c3, c4, c5 FROM c JOIN k ON c_custkey = entity_id""")
def lake_lookup(spark, folder):
    """The whole history of one customer from a lake clustered for look-ups."""
    keys = {"school_year": order_year(), "period": order_period(), "grade": F.col("o_orderstatus")}
    path = f"{scratch(spark)}/counts"
    lake.write_partitioned(customer_counts(spark, folder, keys), path, ("school_year", "period"), lookup="entity_id")
    buyers = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    richest = table(spark, folder, "customer").join(buyers, "c_custkey").orderBy(F.desc("c_acctbal"), F.asc("c_custkey"))
    found = lake.read_partitioned(spark, path).where(F.col("entity_id") == F.lit(richest.select("c_custkey").first()[0]))
    return found.select("entity_id", "school_year", "period", "grade", *[c.alias(f"c{i}") for i, c in enumerate(levels("counts", 5), 1)])


@query("point_lookup", f"""
WITH base AS ({sql_counts(CUSTOMER_YEAR, source='orders')}),
k AS (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1)
SELECT entity_id, yr, grade, c1, c2, c3, c4, c5 FROM base JOIN k ON c_custkey = entity_id WHERE yr IN ('1996', '2000')""")
def point_lookup(spark, folder):
    """The profile of the customer with the largest balance at two timepoints."""
    customers = table(spark, folder, "customer")
    key = customers.orderBy(F.desc("c_acctbal"), F.asc("c_custkey")).limit(1).select("c_custkey")
    counts = yearly(spark, folder)
    found = profile(counts, "entity_id", key.scalar(), "yr", ["1996", "2000"])
    return found.select("entity_id", "yr", "grade", *[c.alias(f"c{i}") for i, c in enumerate(levels("counts", 5), 1)])


@query("lower_band_lookup", f"""
WITH base AS ({sql_counts(CUSTOMER_YEAR, source='orders')}),
b AS (SELECT entity_id, sum(c1 + c2) AS lower_band FROM base GROUP BY entity_id)
SELECT c_custkey AS entity_id, c_nationkey, r_name, lower_band FROM customer
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey LEFT JOIN b ON entity_id = c_custkey""")
def lower_band_lookup(spark, folder):
    """Places of every entity with its lower-band count."""
    nations = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entity_id"), "c_nationkey", "r_name"
    )
    return places.join(lower_band(yearly(spark, folder), ["entity_id"], 5, 2), "entity_id", "left")
