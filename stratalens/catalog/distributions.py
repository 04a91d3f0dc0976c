"""Distributions, moments, scores and validity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.distribution import (
    collapse,
    count_stable,
    level_sum,
    levels,
    percentages,
)
from ..operators.counts import (
    derived_total,
    largest_language_parts,
    level_range_sum,
    long_to_wide,
    lower_band,
    net_gain,
    wide_to_long,
)
from ..operators.moments import (
    entity_moments,
    group_has_data,
    group_moments,
    level_averages,
    ordinal_score,
    performance_score,
    share_of_levels,
    with_shares,
)
from ..operators.validity import count_mismatch, failure_stage, plausible_reassessment, validity
from ..plans.gold import timepoint_table
from ..scales import SEVEN_TO_THREE
from .registry import (
    PRIORITY,
    SALES,
    SALES_BY_STATUS,
    SEGMENTS,
    SQL_MOMENT_AVERAGES,
    SQL_PERIOD,
    SQL_WEEKDAY,
    SQL_YEAR,
    STATUSES,
    customer_counts,
    nation_counts,
    order_year,
    query,
    r,
    rounded,
    sales_by_status,
    sales_counts,
    sql_counts,
    sql_moments,
    sql_shares,
    weekday_level,
)

NATION_YEAR = {"entity_id": "CAST(c_nationkey AS BIGINT)", "yr": SQL_YEAR, "grade": "c_mktsegment"}
CUSTOMER_YEAR = {"entity_id": "o_custkey", "yr": SQL_YEAR}
SALES_KEYS = {
    "entity_id": "CAST(c_nationkey AS BIGINT)", "school_year": SQL_YEAR, "period": SQL_PERIOD, "grade": "c_mktsegment",
}
STATUS_KEYS = {**SALES_KEYS, "lang": "o_orderstatus"}


@query("ordinal_moments", f"""
WITH base AS ({sql_counts(NATION_YEAR)}), shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})
SELECT entity_id, yr, {SQL_MOMENT_AVERAGES} FROM moments GROUP BY entity_id, yr""")
def ordinal_moments(spark, folder):
    counts = nation_counts(spark, folder, {"yr": order_year()})
    return rounded(entity_moments(counts, ["entity_id", "yr"], 5))


@query("moments_null_all", f"""
WITH base AS ({sql_counts(CUSTOMER_YEAR, source='orders')}), shares AS ({sql_shares('base')}),
moments AS ({sql_moments('shares', null_all=True)})
SELECT entity_id, {SQL_MOMENT_AVERAGES} FROM moments GROUP BY entity_id""")
def moments_null_all(spark, folder):
    counts = customer_counts(spark, folder, {"yr": order_year()})
    return rounded(entity_moments(counts, ["entity_id"], 5, null_as_zero=True, zero_sd="null_all"))


@query("moments_positive_sum", f"""
WITH raw AS ({sql_counts(STATUS_KEYS)}),
base AS (SELECT * REPLACE (nullif(c1, 0) AS c1, nullif(c3, 0) AS c3) FROM raw),
shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})
SELECT entity_id, school_year, period, count(p1 + p2 + p3 + p4 + p5) AS groups_with_data,
  {r('avg(CASE WHEN p1 + p2 + p3 + p4 IS NOT NULL THEN p5 END)', 'pct_top_level')}, {SQL_MOMENT_AVERAGES}
FROM moments GROUP BY entity_id, school_year, period""")
def moments_positive_sum(spark, folder):
    """Unreported levels (counts of zero on two levels) make a group incomplete."""
    counts = sales_by_status(spark, folder)
    c = levels("counts", 5)
    gaps = F.array(F.nullif(c[0], F.lit(0.0)), c[1], F.nullif(c[2], F.lit(0.0)), c[3], c[4])
    table = timepoint_table(counts.withColumn("counts", gaps), SALES_BY_STATUS, scores_by_group=False)
    return rounded(table)


@query("pct_distribution", f"""
WITH base AS ({sql_counts({'entity_id': 'CAST(c_nationkey AS BIGINT)', 'grade': 'c_mktsegment'})}),
shares AS ({sql_shares('base')})
SELECT entity_id, grade, {', '.join(r(f'p{i}', f'p{i}') for i in range(1, 6))},
  {r('p1 + p2 + p3 + p4 + p5', 'pct_sum')} FROM shares""")
def pct_distribution(spark, folder):
    shares = with_shares(nation_counts(spark, folder, {}), 5)
    p = levels("shares", 5)
    out = shares.select(
        "entity_id", "grade", *[c.alias(f"p{i}") for i, c in enumerate(p, start=1)], level_sum(p).alias("pct_sum")
    )
    return rounded(out)


@query("collapse_7_to_3", f"""
WITH base AS ({sql_counts({'entity_id': 'o_custkey'}, SQL_WEEKDAY, 7, 'orders')}),
three AS (SELECT *, c1 + c2 + c4 AS f, c3 + c5 AS i, c6 + c7 AS d, c1 + c2 + c3 + c4 + c5 + c6 + c7 AS s FROM base)
SELECT entity_id, f AS n1, i AS n2, d AS n3,
  {r('f / s * 100', 'q1')}, {r('i / s * 100', 'q2')}, {r('d / s * 100', 'q3')},
  {', '.join(r(f'c{i} / s * 100', f'p{i}') for i in range(1, 8))} FROM three""")
def collapse_7_to_3(spark, folder):
    counts = customer_counts(spark, folder, {}, weekday_level(), 7)
    three = counts.withColumn("three", collapse("counts", SEVEN_TO_THREE.mapping))
    shares = three.withColumns({"p": percentages("counts", 7, True), "q": percentages("three", 3)})
    return rounded(shares.select(
        "entity_id",
        *[c.alias(f"n{i}") for i, c in enumerate(levels("three", 3), start=1)],
        *[c.alias(f"q{i}") for i, c in enumerate(levels("q", 3), start=1)],
        *[c.alias(f"p{i}") for i, c in enumerate(levels("p", 7), start=1)],
    ))


@query("conditional_share", f"""
WITH base AS ({sql_counts({**CUSTOMER_YEAR, 'grade': 'o_orderstatus'}, SQL_WEEKDAY, 7, 'orders')}),
shares AS ({sql_shares('base', 7)})
SELECT entity_id, yr,
  {r('avg(CASE WHEN CAST(yr AS INTEGER) % 2 = 0 THEN p7 END)', 'pct_grade_ready')},
  {r('avg(CASE WHEN CAST(yr AS INTEGER) % 2 = 0 THEN p1 + p2 + p3 END)', 'pct_3ld')}
FROM shares GROUP BY entity_id, yr""")
def conditional_share(spark, folder):
    """Shares of chosen levels where the timepoint has them, NULL at the other timepoints."""
    counts = customer_counts(spark, folder, {"yr": order_year(), "grade": F.col("o_orderstatus")}, weekday_level(), 7)
    shares = with_shares(counts, 7, null_as_zero=True)
    has_depth = F.col("yr").cast("int") % 2 == 0
    return rounded(shares.groupBy("entity_id", "yr").agg(
        F.avg(F.when(has_depth, share_of_levels([6], 7))).alias("pct_grade_ready"),
        F.avg(F.when(has_depth, share_of_levels([0, 1, 2], 7))).alias("pct_3ld"),
    ))


@query("timepoints_wide", f"""
WITH base AS ({sql_counts(SALES_KEYS)}), shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})
SELECT entity_id, school_year, period, count(p5) AS groups_with_data, {SQL_MOMENT_AVERAGES},
  {r('avg(p5)', 'pct_top_level')},
  {', '.join(r(f"avg(CASE WHEN grade = '{s}' THEN ordinal_mean END)", f'ordinal_{s}') for s in SEGMENTS)}
FROM moments GROUP BY entity_id, school_year, period""")
def timepoints_wide(spark, folder):
    return rounded(timepoint_table(sales_counts(spark, folder), SALES))


STATUS_GROUPS = [(s, o) for s in SEGMENTS for o in STATUSES]


@query("grade_rollup", f"""
WITH base AS ({sql_counts(STATUS_KEYS)}), shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})
SELECT entity_id, school_year, period, count(p5) AS groups_with_data, {SQL_MOMENT_AVERAGES},
  {r('avg(p5)', 'pct_top_level')},
  {', '.join(r(f"avg(CASE WHEN grade = '{s}' AND lang = '{o}' THEN ordinal_mean END)", f'ordinal_{s}_{o}')
             for s, o in STATUS_GROUPS)},
  {', '.join(r(f"avg(CASE WHEN grade = '{s}' THEN ordinal_mean END)", f'ordinal_{s}') for s in SEGMENTS)}
FROM moments GROUP BY entity_id, school_year, period""")
def grade_rollup(spark, folder):
    return rounded(timepoint_table(sales_by_status(spark, folder), SALES_BY_STATUS))


@query("lower_band", f"""
WITH base AS ({sql_counts({'entity_id': 'o_custkey', 'yr': SQL_YEAR, 'grade': 'o_orderstatus'}, source='orders')})
SELECT entity_id, yr, sum(c1 + c2) AS lower_band FROM base GROUP BY entity_id, yr""")
def lower_band_query(spark, folder):
    counts = customer_counts(spark, folder, {"yr": order_year(), "grade": F.col("o_orderstatus")})
    return lower_band(counts, ["entity_id", "yr"], 5, 2)


@query("lower_band_collapsed", f"""
WITH base AS ({sql_counts({'entity_id': 'o_custkey', 'yr': SQL_YEAR}, SQL_WEEKDAY, 7, 'orders')})
SELECT entity_id, yr, c1 + c2 + c4 AS lower_band FROM base""")
def lower_band_collapsed(spark, folder):
    """Lowest band of a 7-level scale after the collapse to three levels."""
    counts = customer_counts(spark, folder, {"yr": order_year()}, weekday_level(), 7)
    three = counts.withColumn("counts", collapse("counts", SEVEN_TO_THREE.mapping))
    return lower_band(three, ["entity_id", "yr"], 3, 1)


@query("net_gain", f"""
WITH base AS ({sql_counts(CUSTOMER_YEAR, source='orders')}),
wide AS (SELECT entity_id,
  sum(CASE WHEN yr = '1996' THEN c4 + c5 END) AS u0, sum(CASE WHEN yr = '1997' THEN c4 + c5 END) AS u1,
  sum(CASE WHEN yr = '1996' THEN c5 END) AS t0, sum(CASE WHEN yr = '1997' THEN c5 END) AS t1
  FROM base WHERE yr IN ('1996', '1997') GROUP BY entity_id)
SELECT entity_id, u1 - u0 AS net_gain_upper, t1 - t0 AS net_gain_top FROM wide""")
def net_gain_query(spark, folder):
    counts = customer_counts(spark, folder, {"yr": order_year()})
    return net_gain(counts, "entity_id", F.col("yr") == "1996", F.col("yr") == "1997", 5)


WEIGHTS = (0, 13, 42, 77, 100)


@query("performance_score", f"""
WITH raw AS ({sql_counts(STATUS_KEYS)}),
base AS (SELECT * REPLACE (nullif(c2, 0) AS c2) FROM raw), shares AS ({sql_shares('base')})
SELECT entity_id, school_year, period,
  {r("sum(" + " + ".join(f"coalesce(p{i} * {w}, 0)" for i, w in enumerate(WEIGHTS, 1)) + ") / nullif(sum("
     + " + ".join(f"CASE WHEN p{i} IS NOT NULL THEN {w} ELSE 0 END" for i, w in enumerate(WEIGHTS, 1)) + "), 0)",
     "performance")}
FROM shares GROUP BY entity_id, school_year, period""")
def performance_score_query(spark, folder):
    counts = sales_by_status(spark, folder)
    c = levels("counts", 5)
    gaps = F.array(c[0], F.nullif(c[1], F.lit(0.0)), c[2], c[3], c[4])
    keys = ["entity_id", "school_year", "period"]
    return rounded(performance_score(counts.withColumn("counts", gaps), keys, WEIGHTS))


LEVEL_NAMES = ("urgent", "high", "medium", "unspecified", "low")


@query("level_averages", f"""
WITH base AS ({sql_counts(SALES_KEYS)}), shares AS ({sql_shares('base')})
SELECT entity_id, school_year, period,
  {', '.join(r(f'avg(p{i})', f'avg_{n}') for i, n in enumerate(LEVEL_NAMES, 1))},
  {', '.join(r(f'avg(p{i}) * {w} / 100', f'weighted_{n}') for i, (n, w) in enumerate(zip(LEVEL_NAMES, WEIGHTS), 1))}
FROM shares GROUP BY entity_id, school_year, period""")
def level_averages_query(spark, folder):
    keys = ["entity_id", "school_year", "period"]
    weights = dict(zip(LEVEL_NAMES, WEIGHTS, strict=True))
    return rounded(level_averages(sales_counts(spark, folder), keys, LEVEL_NAMES, weights))


@query("scoring_modes", f"""
WITH base AS ({sql_counts(SALES_KEYS)}), shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})
SELECT entity_id, school_year, period,
  count(p5) > 0 AS valid,
  CASE WHEN count(p5) > 0 THEN {r('avg(ordinal_mean)', 'x').removesuffix(' AS x')} END AS ordinal,
  CASE WHEN count(p5) > 0 THEN {r("sum(" + " + ".join(f"p{i} * {w}" for i, w in enumerate(WEIGHTS, 1))
     + f") / nullif(sum({sum(WEIGHTS)}), 0)", 'x').removesuffix(' AS x')} END AS weighted
FROM moments GROUP BY entity_id, school_year, period""")
def scoring_modes(spark, folder):
    """The ordinal and the weighted score of every timepoint side by side, masked where invalid."""
    from ..plans.scoring import score_timepoints

    counts = sales_counts(spark, folder)
    keys = ["entity_id", "school_year", "period"]
    ordinal = score_timepoints(counts, SALES, keys, scoring="ordinal")
    weighted = score_timepoints(counts, SALES, keys, scoring="pca", weights=WEIGHTS)
    return rounded(
        ordinal.select(*keys, "valid", F.col("perf").alias("ordinal"))
        .join(weighted.select(*keys, F.col("perf").alias("weighted")), keys)
    )


def sql_validity(source: str, keys: list[str], grades, groups, min_groups: int, min_assessed: int) -> str:
    """Flags from shares: a group has data when its sum is positive."""
    has = ", ".join(
        f"coalesce(bool_or(grade = '{g}'{'' if o is None else f' AND lang = {chr(39)}{o}{chr(39)}'} AND s > 0), false)"
        f" AS has_{g}{'' if o is None else '_' + o}" for g, o in groups
    )
    every = " AND ".join(f"coalesce(bool_or(grade = '{g}' AND s > 0), false)" for g in grades)
    names = ", ".join(keys)
    return f"""
    SELECT *, groups_available > 0 AS valid,
      (groups_available > 0 AND has_all_grades AND groups_available >= {min_groups}
       AND coalesce(min_group_assessed >= {min_assessed}, false)) AS valid_strict
    FROM (SELECT {names}, {has}, count(*) FILTER (WHERE s > 0) AS groups_available,
      CAST(min(CASE WHEN s > 0 THEN s END) AS BIGINT) AS min_group_assessed, {every} AS has_all_grades
      FROM {source} GROUP BY {names})"""


VALIDITY_SQL = sql_validity(
    "shares", ["entity_id", "school_year", "period"], SEGMENTS, [(s, None) for s in SEGMENTS], 4, 7
)
STRICT_AT = 7


@query("validity_flags", f"""
WITH base AS ({sql_counts(SALES_KEYS)}), shares AS ({sql_shares('base')}), flags AS ({VALIDITY_SQL})
SELECT *, CASE WHEN NOT valid THEN 'no_data' WHEN NOT has_all_grades THEN 'missing_grade'
  WHEN groups_available < 4 THEN 'few_groups' WHEN coalesce(min_group_assessed < {STRICT_AT}, true) THEN 'small_group'
  ELSE 'strict' END AS stage FROM flags""")
def validity_flags(spark, folder):
    flags = validity(
        sales_counts(spark, folder), ["entity_id", "school_year", "period"], SALES.groups, 5, min_assessed=STRICT_AT
    )
    return flags.withColumn("stage", failure_stage(min_assessed=STRICT_AT))


COMPLETE_SQL = sql_validity(
    "complete", ["entity_id", "school_year", "period"], SEGMENTS, STATUS_GROUPS, 4, 3
)


@query("validity_complete_groups", f"""
WITH raw AS ({sql_counts(STATUS_KEYS)}),
complete AS (SELECT *, CASE WHEN c1 > 0 THEN c1 + c2 + c3 + c4 + c5 END AS s FROM raw)
{COMPLETE_SQL}""")
def validity_complete_groups(spark, folder):
    """Validity where a group needs every level; an unreported first level makes it incomplete."""
    counts = sales_by_status(spark, folder)
    c = levels("counts", 5)
    gaps = counts.withColumn("counts", F.array(F.nullif(c[0], F.lit(0.0)), *c[1:]))
    return validity(
        gaps, ["entity_id", "school_year", "period"], SALES_BY_STATUS.groups, 5, mode="all", min_assessed=3
    )


@query("plausibility", f"""
WITH base AS ({sql_counts({'entity_id': 'o_custkey', 'yr': SQL_YEAR, 'grade': 'o_orderstatus'}, source='orders')}),
t AS (SELECT entity_id,
  sum(CASE WHEN yr = '1996' THEN c1 + c2 + c3 + c4 END) AS pool,
  sum(CASE WHEN yr = '1996' THEN c1 + c2 + c3 + c4 + c5 END) AS n0,
  sum(CASE WHEN yr = '1997' THEN c1 + c2 + c3 + c4 + c5 END) AS n1
  FROM base GROUP BY entity_id)
SELECT entity_id, n0, n1, pool, n1 <= pool * 1.10 AS plausible,
  coalesce(abs(n1 - n0) / nullif(n0, 0) > 0.25, true) AS mismatch,
  coalesce(abs(n1 - n0) / nullif(n0, 0) > 0.25, false) AS mismatch_known_only,
  coalesce(abs(n1 - n0) / nullif(n0, 0) <= 0.25, false) AS count_stable
FROM t""")
def plausibility(spark, folder):
    counts = customer_counts(spark, folder, {"yr": order_year(), "grade": F.col("o_orderstatus")})
    total, pool = level_range_sum(5, 1, 5), level_range_sum(5, 1, 4)
    wide = counts.groupBy("entity_id").agg(
        F.sum(F.when(F.col("yr") == "1996", total)).alias("n0"),
        F.sum(F.when(F.col("yr") == "1997", total)).alias("n1"),
        F.sum(F.when(F.col("yr") == "1996", pool)).alias("pool"),
    )
    n0, n1 = F.col("n0"), F.col("n1")
    return wide.select(
        "entity_id", "n0", "n1", "pool",
        plausible_reassessment(n1, F.col("pool")).alias("plausible"),
        count_mismatch(n0, n1).alias("mismatch"),
        count_mismatch(n0, n1, unknown=False).alias("mismatch_known_only"),
        count_stable(n0, n1).alias("count_stable"),
    )


CHAIN = (("F", ("F",)), ("OP", ("P", "O")))


@query("total_assessed", f"""
WITH base AS ({sql_counts({**CUSTOMER_YEAR, 'grade': 'o_orderstatus'}, source='orders')}),
sums AS (SELECT *, c1 + c2 + c3 + c4 + c5 AS s FROM base),
wide AS (SELECT entity_id, yr, coalesce(sum(CASE WHEN grade = 'F' THEN s END), 0) AS f,
  coalesce(sum(CASE WHEN grade = 'P' THEN s END), 0) AS p, coalesce(sum(CASE WHEN grade = 'O' THEN s END), 0) AS o,
  sum(s) AS reported FROM sums GROUP BY entity_id, yr),
d AS (SELECT *, f + CASE WHEN p > 0 THEN p ELSE o END AS derived FROM wide)
SELECT entity_id, yr, derived AS derived_total, reported AS reported_total,
  abs(reported - derived) AS difference FROM d""")
def total_assessed(spark, folder):
    """Reported total against the total derived from one language per grade."""
    counts = customer_counts(spark, folder, {"yr": order_year(), "grade": F.col("o_orderstatus")})
    counts = counts.withColumn("lang", F.lit(None).cast("string"))
    keys = ["entity_id", "yr"]
    derived = derived_total(counts, keys, 5, CHAIN)
    reported = counts.groupBy(*keys).agg(F.sum(level_range_sum(5, 1, 5)).alias("reported_total"))
    return derived.join(reported, keys).withColumn(
        "difference", F.abs(F.col("reported_total") - F.col("derived_total"))
    )


@query("largest_language_total", f"""
WITH base AS ({sql_counts(STATUS_KEYS)}),
g AS (SELECT entity_id, school_year, period, grade, max(c1 + c2 + c3 + c4 + c5) AS a, max(c1 + c2 + c3 + c4) AS b
  FROM base GROUP BY entity_id, school_year, period, grade)
SELECT entity_id, school_year, period, sum(a) AS total, sum(b) AS pool FROM g
GROUP BY entity_id, school_year, period""")
def largest_language(spark, folder):
    """Sum over grades of the largest language group, with and without the best level."""
    counts = sales_by_status(spark, folder)
    keys = ["entity_id", "school_year", "period"]
    total_parts, total = largest_language_parts(SEGMENTS, 5)
    pool_parts, pool = largest_language_parts(SEGMENTS, 5, without_top=True)
    return counts.groupBy(*keys).agg(*total_parts, *pool_parts).select(*keys, total.alias("total"), pool.alias("pool"))


@query("wide_to_long", f"""
WITH base AS ({sql_counts(SALES_KEYS)})
SELECT entity_id, school_year, period, grade, c1, c2, c3, c4, c5, c1 + c2 + c3 + c4 + c5 AS group_sum FROM base""")
def wide_long_round_trip(spark, folder):
    """Counts to one column per group and level and back."""
    counts = sales_counts(spark, folder)
    keys = ["entity_id", "school_year", "period"]
    wide = long_to_wide(counts, keys, SALES.groups, PRIORITY)
    back = wide_to_long(wide, keys, SALES.groups, PRIORITY)
    c = levels("counts", 5)
    named = back.select(*keys, "grade", *[x.alias(f"c{i}") for i, x in enumerate(c, 1)], level_sum(c).alias("group_sum"))
    return named.filter(F.col("c1").isNotNull())


@query("ordinal_score", f"""
WITH base AS ({sql_counts(CUSTOMER_YEAR, source='orders')}), shares AS ({sql_shares('base')})
SELECT entity_id, {r('avg((p1 + 2 * p2 + 3 * p3 + 4 * p4 + 5 * p5) / 100)', 'ordinal_score')}
FROM shares GROUP BY entity_id""")
def ordinal_score_query(spark, folder):
    return rounded(ordinal_score(customer_counts(spark, folder, {"yr": order_year()}), ["entity_id"], 5))


@query("groups_with_data", f"""
WITH base AS ({sql_counts({**CUSTOMER_YEAR, 'grade': 'o_orderstatus'}, source='orders')}),
shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})
SELECT entity_id, yr, count(*) AS groups_with_data,
  count(*) FILTER (WHERE ordinal_sd = 0) AS one_level_groups FROM moments GROUP BY entity_id, yr""")
def groups_with_data(spark, folder):
    counts = customer_counts(spark, folder, {"yr": order_year(), "grade": F.col("o_orderstatus")})
    return group_moments(counts, 5).groupBy("entity_id", "yr").agg(
        F.count_if(group_has_data(5)).alias("groups_with_data"),
        F.count_if(F.col("ordinal_sd") == 0).alias("one_level_groups"),
    )
