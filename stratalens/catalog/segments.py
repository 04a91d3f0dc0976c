"""Segments, chains and what is told about entities that fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.counts import largest_language_parts, largest_language_total
from ..operators.keysets import first_known
from ..operators.moments import entity_moments
from ..operators.ranks import exact_quantiles
from ..operators.shift import segment_changes
from ..plans.chain import chain_long, chain_progress, segment_summary
from ..plans.gold import begin_depth, begin_total, segment_table, timepoint_table, year_over_year
from ..plans.reference import REASON_FIELDS, ReportYear, with_reasons
from ..plans.scoring import score_timepoints
from ..plans.segments import make_segment, present_chain, present_learning, present_segments, present_steps, present_timepoints
from ..scales import READING_7, Group, Instrument, Scale
from ..session import materialise
from .distributions import STRICT_AT, VALIDITY_SQL
from .registry import (
    SALES,
    SQL_PERIOD,
    SQL_WEEKDAY,
    SQL_YEAR,
    STATUSES,
    customer_counts,
    order_period,
    order_year,
    query,
    r,
    rounded,
    sales_counts,
    sql_counts,
    sql_emd,
    sql_learning,
    sql_moments,
    sql_segments,
    sql_shares,
    sql_steps,
    table,
    weekday_level,
)


def sql_segment_rows(segments) -> str:
    rows = ", ".join(
        f"({s.index}, '{s.label}', '{s.kind}', '{s.start}', '{s.end}', '{s.start_label}', '{s.end_label}')"
        for s in segments
    )
    return f"SELECT * FROM (VALUES {rows}) AS v(seg_idx, segment_label, segment_kind, tp0, tp1, tp_from, tp_to)"


def sql_changes(size: int, keep: str = "start") -> str:
    """From CTEs moments(entity_id, tp, grade, p1.., moments) and segs: one row per entity and segment."""
    join = {"start": "LEFT JOIN", "both": "JOIN"}[keep]
    return f"""
    t AS (SELECT entity_id, tp, avg(ordinal_mean) AS m, avg(ordinal_sd) AS sd, avg(ordinal_skew) AS sk
      FROM moments GROUP BY entity_id, tp),
    e AS (SELECT a.entity_id, seg_idx, avg({sql_emd('a', 'b', size)}) AS emd, count({sql_emd('a', 'b', size)}) AS n
      FROM segs JOIN moments a ON a.tp = tp0
      JOIN moments b ON b.tp = tp1 AND a.entity_id = b.entity_id AND a.grade = b.grade GROUP BY a.entity_id, seg_idx),
    changes AS (SELECT t0.entity_id, segs.seg_idx, segment_label, segment_kind, tp_from, tp_to,
        t1.m - t0.m AS delta_mean, t1.sd - t0.sd AS delta_sd, t1.sk - t0.sk AS delta_skew,
        emd AS emd_mean, coalesce(n, 0) AS groups_common
      FROM segs JOIN t t0 ON t0.tp = tp0
      {join} t t1 ON t1.tp = tp1 AND t1.entity_id = t0.entity_id
      LEFT JOIN e ON e.entity_id = t0.entity_id AND e.seg_idx = segs.seg_idx)"""


CHANGES_OUT = f"""SELECT entity_id, seg_idx, segment_label, segment_kind, tp_from, tp_to,
  {r('delta_mean', 'delta_mean')}, {r('delta_sd', 'delta_sd')}, {r('delta_skew', 'delta_skew')},
  {r('emd_mean', 'emd_mean')}, groups_common FROM changes"""

TP = f"concat_ws(' ', {SQL_PERIOD}, {SQL_YEAR})"
SALES_TP = {"entity_id": "CAST(c_nationkey AS BIGINT)", "tp": TP, "grade": "c_mktsegment"}
SALES_MOMENTS = f"base AS ({sql_counts(SALES_TP)}), shares AS ({sql_shares('base')}), moments AS ({sql_moments('shares')})"

ORDER_SEGMENTS = sql_segments("orders", SQL_YEAR, SQL_PERIOD)
STEPS = sql_steps("orders", SQL_YEAR)
CUSTOMER_YEARS = {"entity_id": "o_custkey", "tp": SQL_YEAR, "grade": "o_orderstatus"}


def step_changes(spark, folder, keep):
    """Changes of customers between neighbouring years of those that orders have."""
    counts = materialise(customer_counts(spark, folder, {"yr": order_year(), "grade": F.col("o_orderstatus")}))
    steps = present_steps(counts.select("yr"))
    return segment_changes(counts, ["entity_id"], ["grade"], "yr", steps, 5, keep=keep)


@query("emd_segments", f"""
WITH base AS ({sql_counts(CUSTOMER_YEARS, source='orders')}), shares AS ({sql_shares('base')}),
moments AS ({sql_moments('shares')}), {STEPS}, {sql_changes(5, 'both')} {CHANGES_OUT}""")
def emd_segments(spark, folder):
    """Neighbouring years, customers present in both."""
    return rounded(step_changes(spark, folder, "both"))


@query("segment_deltas", f"""
WITH {SALES_MOMENTS}, {ORDER_SEGMENTS}, {sql_changes(5)} {CHANGES_OUT}""")
def segment_deltas(spark, folder):
    """All segments of the timepoints present: within years, year over year, end to end."""
    counts = materialise(sales_counts(spark, folder))
    return rounded(segment_table(counts, SALES, present_segments(present_timepoints(counts))))


@query("segment_deltas_start_side", f"""
WITH base AS ({sql_counts(CUSTOMER_YEARS, source='orders')}), shares AS ({sql_shares('base')}),
moments AS ({sql_moments('shares')}), {STEPS}, {sql_changes(5)} {CHANGES_OUT}""")
def segment_deltas_start_side(spark, folder):
    """Customers present at the start keep their row when the end is missing."""
    return rounded(step_changes(spark, folder, "start"))


WEEKDAYS = Instrument("weekdays", READING_7, tuple(Group(s) for s in STATUSES), null_as_zero=True, zero_sd="null_all")
YOY = make_segment(0, ("1996", "BoSY"), ("1997", "BoSY"))
WEEKDAY_TP = {"entity_id": "o_custkey", "tp": TP, "grade": "o_orderstatus"}


def weekday_counts(spark, folder):
    keys = {"school_year": order_year(), "period": order_period(), "grade": F.col("o_orderstatus")}
    counts = customer_counts(spark, folder, keys, weekday_level(), 7)
    return counts.withColumn("lang", F.lit(None).cast("string"))


@query("yoy_inner", f"""
WITH base AS ({sql_counts(WEEKDAY_TP, SQL_WEEKDAY, 7, 'orders')}), shares AS ({sql_shares('base', 7)}),
moments AS ({sql_moments('shares', 7, null_all=True)}), segs AS ({sql_segment_rows([YOY])}), {sql_changes(7, 'both')},
d AS (SELECT entity_id, tp, avg(p7) AS gr, avg(p1 + p2 + p3) AS deep, sum(s) AS total
  FROM moments GROUP BY entity_id, tp)
SELECT c.entity_id, {r('delta_mean', 'delta_mean')}, {r('delta_sd', 'delta_sd')}, {r('delta_skew', 'delta_skew')},
  {r('b.gr - a.gr', 'delta_pct_grade_ready')}, {r('b.deep - a.deep', 'delta_pct_3ld')}, {r('emd_mean', 'emd_mean')},
  coalesce(abs(b.total - a.total) / nullif(a.total, 0) <= 0.25, false) AS count_stable
FROM changes c JOIN d a ON a.entity_id = c.entity_id AND a.tp = c.tp_from
JOIN d b ON b.entity_id = c.entity_id AND b.tp = c.tp_to""")
def yoy_inner(spark, folder):
    counts = weekday_counts(spark, folder)
    totals = largest_language_total(
        counts, ["entity_id", "school_year", "period"], STATUSES, 7, name="total_assessed"
    )
    return rounded(year_over_year(counts, totals, WEEKDAYS, YOY))


FLAGS = Scale("return_flag", ("A", "N", "R"))
RETURNS = Instrument("returns", FLAGS, (Group("F"), Group("O")), null_as_zero=True, zero_sd="null_all")
SHIP_YEAR, SHIP_PERIOD = "CAST(year(l_shipdate) AS VARCHAR)", "CASE WHEN month(l_shipdate) <= 6 THEN 'BoSY' ELSE 'EoSY' END"
LEARNING = sql_learning("lineitem", SHIP_YEAR, SHIP_PERIOD)
RETURN_LEVEL = "(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END)"
RETURN_TP = {"entity_id": "l_suppkey", "tp": f"concat_ws(' ', {SHIP_PERIOD}, {SHIP_YEAR})", "grade": "l_linestatus"}


def return_counts(spark, folder):
    from ..operators.counts import records_to_counts

    lines = table(spark, folder, "lineitem")
    level = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    keys = [
        F.col("l_suppkey").alias("entity_id"),
        F.year("l_shipdate").cast("string").alias("school_year"),
        F.when(F.month("l_shipdate") <= 6, "BoSY").otherwise("EoSY").alias("period"),
        F.col("l_linestatus").alias("grade"),
    ]
    return records_to_counts(lines, keys, level, 3).withColumn("lang", F.lit(None).cast("string"))


@query("chain_segments_3level", f"""
WITH base AS ({sql_counts(RETURN_TP, RETURN_LEVEL, 3, 'lineitem')}), shares AS ({sql_shares('base', 3)}),
moments AS ({sql_moments('shares', 3, null_all=True)}), {LEARNING}, {sql_changes(3)}
{CHANGES_OUT}""")
def chain_segments_3level(spark, folder):
    """Begin-to-end segments of each year on a 3-level scale."""
    counts = materialise(return_counts(spark, folder))
    return rounded(segment_table(counts, RETURNS, present_learning(present_timepoints(counts))))


MOMENT_NAMES = ("ordinal_mean", "ordinal_sd", "ordinal_skew", "ordinal_kurt", "bimodality_coef")


@query("timepoints_3level", f"""
WITH base AS ({sql_counts(RETURN_TP, RETURN_LEVEL, 3, 'lineitem')}), shares AS ({sql_shares('base', 3)}),
moments AS ({sql_moments('shares', 3, null_all=True)})
SELECT entity_id, split_part(tp, ' ', 2) AS school_year, split_part(tp, ' ', 1) AS period,
  count(p1) AS groups_with_data, {', '.join(r(f'avg({m})', m) for m in MOMENT_NAMES)},
  {r('avg(p3)', 'pct_top_level')}, sum(s) AS total_assessed FROM moments GROUP BY entity_id, tp""")
def timepoints_3level(spark, folder):
    counts = return_counts(spark, folder)
    keys = ["entity_id", "school_year", "period"]
    parts, total = largest_language_parts(RETURNS.grades, 3)
    table = timepoint_table(counts, RETURNS, scores_by_group=False, extra=parts).withColumn("total_assessed", total)
    return rounded(table.drop(*[c for c in table.columns if c.startswith("_")]))


@query("timepoints_depth", f"""
WITH base AS ({sql_counts(WEEKDAY_TP, SQL_WEEKDAY, 7, 'orders')}), shares AS ({sql_shares('base', 7)})
SELECT entity_id, split_part(tp, ' ', 2) AS school_year, split_part(tp, ' ', 1) AS period,
  {r('avg(p7)', 'pct_grade_ready')}, {r('avg(p1 + p2 + p3)', 'pct_3ld')},
  sum(s) AS total_assessed, sum(s) AS total_from_assessed
FROM shares WHERE starts_with(tp, 'BoSY') GROUP BY entity_id, tp""")
def timepoints_depth(spark, folder):
    """Depth shares and learners at the begin of the year, from groups and from an assessed column."""
    counts = weekday_counts(spark, folder).filter(F.col("period") == "BoSY")
    keys = ["entity_id", "school_year", "period"]
    orders = table(spark, folder, "orders").filter(order_period() == "BoSY")
    assessed = orders.groupBy(
        F.col("o_custkey").alias("entity_id"), order_year().alias("school_year"), order_period().alias("period"),
        F.col("o_orderstatus").alias("grade"),
    ).agg(F.count(F.lit(1)).cast("double").alias("assessed"))
    by_column = begin_total(counts, STATUSES, assessed, keys).withColumnRenamed("total_assessed", "total_from_assessed")
    return rounded(begin_depth(counts, keys).join(begin_total(counts, STATUSES, None, keys), keys).join(by_column, keys))


def chain_inputs(counts):
    """Scores, flags and totals of every timepoint, as chain progress takes them."""
    counts = counts.withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    scored = score_timepoints(
        counts, SALES, ["entity_id", "timepoint_label"], scoring="ordinal", min_assessed=STRICT_AT
    )
    return scored.withColumnRenamed("derived_total", "total_assessed")


def sql_chain_ctes(moments: str, flags: str, segments: str, total: str = "sum(s)", threshold: float = 0.25) -> str:
    """CTE chain: one row per entity and segment of the CTEs ``segments``; ``tf`` has scores and flags per timepoint."""
    return f"""{moments}, {segments},
    flags AS ({flags}),
    t AS (SELECT entity_id, tp, avg(ordinal_mean) AS perf, avg(ordinal_sd) AS sd, avg(ordinal_skew) AS skew,
      {total} AS total FROM moments GROUP BY entity_id, tp),
    tf AS (SELECT * FROM t JOIN flags USING (entity_id, tp)),
    chain0 AS (SELECT e.entity_id, segs.seg_idx, segment_label,
        b.perf - a.perf AS delta, b.sd - a.sd AS sd_delta, b.skew - a.skew AS skew_delta,
        coalesce(abs(b.total - a.total) / nullif(a.total, 0) <= {threshold}, false) AS count_stable,
        coalesce(a.valid AND b.valid, false) AS bv, coalesce(a.valid_strict AND b.valid_strict, false) AS bs
      FROM (SELECT DISTINCT entity_id FROM t) e CROSS JOIN segs
      LEFT JOIN tf a ON a.entity_id = e.entity_id AND a.tp = tp0
      LEFT JOIN tf b ON b.entity_id = e.entity_id AND b.tp = tp1),
    chain AS (SELECT entity_id, seg_idx, segment_label, count_stable, bv AND count_stable AS valid,
        bs AND count_stable AS valid_strict,
        CASE WHEN bv AND count_stable THEN delta END AS delta,
        CASE WHEN bv AND count_stable THEN sd_delta END AS sd_delta,
        CASE WHEN bv AND count_stable THEN skew_delta END AS skew_delta FROM chain0)"""


def sql_chain() -> str:
    flags = VALIDITY_SQL.replace("entity_id, school_year, period", "entity_id, tp")
    return sql_chain_ctes(SALES_MOMENTS, flags, ORDER_SEGMENTS)


def chain_of(spark, folder):
    """Chain progress over the timepoints present, those timepoints, and their segments."""
    counts = materialise(sales_counts(spark, folder))
    points, segments = present_chain(counts)
    progress = chain_progress(chain_inputs(counts), "entity_id", points, segments, carry=REASON_FIELDS)
    return progress, points, segments


def progress_of(spark, folder):
    return chain_of(spark, folder)[0]


def long_chain(spark, folder):
    progress, _, segments = chain_of(spark, folder)
    return chain_long(progress, "entity_id", segments)


@query("chain_progress", f"""
WITH {sql_chain()} SELECT entity_id, seg_idx, segment_label, count_stable, valid, valid_strict,
  {r('delta', 'delta')}, {r('sd_delta', 'sd_delta')}, {r('skew_delta', 'skew_delta')} FROM chain""")
def chain_progress_query(spark, folder):
    return rounded(long_chain(spark, folder))


@query("chain_composite", f"""
WITH {sql_chain()} SELECT entity_id, CAST(count(*) FILTER (WHERE valid) AS INTEGER) AS segments_available,
  CAST(count(*) FILTER (WHERE valid_strict) AS INTEGER) AS segments_available_strict,
  {r("sum(CASE WHEN starts_with(segment_label, 'Learning_') THEN delta END)", 'composite_score')},
  {r("sum(CASE WHEN starts_with(segment_label, 'Learning_') THEN sd_delta END)", 'composite_sd_delta')},
  {r("sum(CASE WHEN starts_with(segment_label, 'Learning_') THEN skew_delta END)", 'composite_skew_delta')}
FROM chain GROUP BY entity_id""")
def chain_composite(spark, folder):
    return rounded(progress_of(spark, folder).select(
        "entity_id", "segments_available", "segments_available_strict",
        "composite_score", "composite_sd_delta", "composite_skew_delta",
    ))


@query("segment_summary", f"""
WITH {sql_chain()} SELECT seg_idx, segment_label, count(*) AS entities, count(*) FILTER (WHERE valid) AS n_valid,
  count(*) FILTER (WHERE valid_strict) AS n_strict, {r('avg(delta)', 'mean_delta')}
FROM chain GROUP BY seg_idx, segment_label""")
def segment_summary_query(spark, folder):
    return rounded(segment_summary(long_chain(spark, folder)))


@query("first_known_metadata", """
WITH o AS (SELECT o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS yr, min(o_orderstatus) AS status,
    max(CASE WHEN o_totalprice > 300000 THEN o_orderpriority END) AS big_priority FROM orders GROUP BY 1, 2)
SELECT entity_id, min_by(status, yr) AS status,
  min_by(big_priority, yr) FILTER (WHERE big_priority IS NOT NULL) AS big_priority FROM o GROUP BY entity_id""")
def first_known_metadata(spark, folder):
    """First non-missing value per column over the years, each column for itself."""
    yearly = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("entity_id"), F.year("o_orderdate").alias("yr")
    ).agg(
        F.min("o_orderstatus").alias("status"),
        F.max(F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority"))).alias("big_priority"),
    )
    return yearly.groupBy("entity_id").agg(*first_known(["status", "big_priority"], F.col("yr")))


@query("national_means", f"""
WITH {SALES_MOMENTS}, e AS (SELECT entity_id, tp, {', '.join(f'avg({m}) AS {m}' for m in MOMENT_NAMES)}
  FROM moments GROUP BY entity_id, tp)
SELECT tp AS timepoint_label, count(*) AS n_valid, {', '.join(r(f'avg({m})', m) for m in MOMENT_NAMES)}
FROM e GROUP BY tp""")
def national_means(spark, folder):
    counts = sales_counts(spark, folder).withColumn("timepoint_label", F.concat_ws(" ", "period", "school_year"))
    entities = entity_moments(counts, ["entity_id", "timepoint_label"], 5)
    return rounded(entities.groupBy("timepoint_label").agg(
        F.count(F.lit(1)).alias("n_valid"), *[F.avg(m).alias(m) for m in MOMENT_NAMES]
    ))


@query("segment_histogram", f"""
WITH {sql_chain()}, n AS (SELECT entity_id, CAST(count(*) FILTER (WHERE valid) AS INTEGER) AS segments_available
  FROM chain GROUP BY entity_id)
SELECT segments_available, count(*) AS entities FROM n GROUP BY segments_available""")
def segment_histogram(spark, folder):
    return progress_of(spark, folder).groupBy("segments_available").agg(F.count(F.lit(1)).alias("entities"))


def report_years(years, segments):
    """Report years with the numbers that their segments have among those present."""
    numbers = {s.label: n for n, s in enumerate(segments, start=1)}
    return [ReportYear(f"SY {y}", y, f"BoSY {y}", f"EoSY {y}", numbers[f"Learning_{y}"]) for y in years]


def sql_tags(alias: str, label: str, min_assessed: int) -> str:
    usable = f"{alias}.valid"
    return f"""CASE WHEN {alias}.entity_id IS NULL THEN 'not in {label} dataset' END,
      CASE WHEN NOT {usable} THEN 'no valid groups at {label}' END,
      CASE WHEN {usable} AND NOT {alias}.has_all_grades THEN 'missing grade level(s) at {label}' END,
      CASE WHEN {usable} AND {alias}.groups_available < 4
        THEN 'only ' || {alias}.groups_available || ' groups at {label}' END,
      CASE WHEN {usable} AND {alias}.min_group_assessed < {min_assessed}
        THEN 'min ' || {alias}.min_group_assessed || ' assessed/group at {label}' END"""


def sql_reason(year: str, at: int) -> str:
    label0, tp0, label1, tp1, heading = "BoSY", f"BoSY {year}", "EoSY", f"EoSY {year}", f"SY {year}"
    tags = f"{sql_tags('a', label0, at)}, {sql_tags('b', label1, at)}"
    return f"""SELECT c.entity_id, CASE WHEN NOT c.valid_strict THEN '{heading}: ' || coalesce(nullif(concat_ws('; ', {tags},
      CASE WHEN NOT c.count_stable AND a.entity_id IS NOT NULL AND b.entity_id IS NOT NULL AND a.valid AND b.valid
        THEN 'unstable count (>25% change)' END), ''), 'failed strict validation') END AS reason
      FROM (SELECT * FROM chain WHERE segment_label = 'Learning_{year}') c
      LEFT JOIN (SELECT * FROM flags WHERE tp = '{tp0}') a ON a.entity_id = c.entity_id
      LEFT JOIN (SELECT * FROM flags WHERE tp = '{tp1}') b ON b.entity_id = c.entity_id"""


REASON_SQL = f"""{sql_chain()}, r1 AS ({sql_reason('1999', STRICT_AT)}),
r2 AS ({sql_reason('2001', STRICT_AT)}),
reasons AS (SELECT entity_id, concat_ws(' | ', r1.reason, r2.reason) AS exclusion_reason FROM r1 JOIN r2 USING (entity_id))"""


@query("exclusion_reason", f"WITH {REASON_SQL} SELECT * FROM reasons")
def exclusion_reason_query(spark, folder):
    progress, points, segments = chain_of(spark, folder)
    progress = with_reasons(progress, report_years(("1999", "2001"), segments), points, min_assessed=STRICT_AT)
    return progress.select("entity_id", "exclusion_reason")


@query("hidden_reshuffle", f"""
WITH base AS ({sql_counts(CUSTOMER_YEARS, source='orders')}), shares AS ({sql_shares('base')}),
moments AS ({sql_moments('shares')}), {STEPS}, {sql_changes(5, 'both')},
q AS (SELECT seg_idx, quantile_cont(emd_mean, 0.75) AS q75 FROM changes GROUP BY seg_idx)
SELECT entity_id, seg_idx, {r('delta_mean', 'delta_mean')}, {r('emd_mean', 'emd_mean')}
FROM changes JOIN q USING (seg_idx) WHERE abs(delta_mean) < 0.1 AND emd_mean > q75""")
def hidden_reshuffle(spark, folder):
    """Entities whose mean hardly moves although their distribution does."""
    changes = materialise(step_changes(spark, folder, "both").select("entity_id", "seg_idx", "delta_mean", "emd_mean"))
    limits = exact_quantiles(changes, "emd_mean", [0.75], ["seg_idx"])
    out = changes.join(F.broadcast(limits.select("seg_idx", "quantile")), "seg_idx")
    return rounded(
        out.filter((F.abs("delta_mean") < 0.1) & (F.col("emd_mean") > F.col("quantile"))).drop("quantile")
    )


@query("delta_distance_correlation", f"""
WITH base AS ({sql_counts(CUSTOMER_YEARS, source='orders')}), shares AS ({sql_shares('base')}),
moments AS ({sql_moments('shares')}), {STEPS}, {sql_changes(5, 'both')}
SELECT seg_idx, {r('corr(delta_mean, emd_mean)', 'correlation')}, {r('avg(emd_mean)', 'mean_emd')},
  {r('stddev_samp(emd_mean)', 'sd_emd')} FROM changes GROUP BY seg_idx""")
def delta_distance_correlation(spark, folder):
    changes = step_changes(spark, folder, "both")
    return rounded(changes.groupBy("seg_idx").agg(
        F.corr("delta_mean", "emd_mean").alias("correlation"),
        F.avg("emd_mean").alias("mean_emd"),
        F.stddev_samp("emd_mean").alias("sd_emd"),
    ))
