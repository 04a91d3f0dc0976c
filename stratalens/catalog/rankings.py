"""Z-scores, percentile ranks, priority rankings and their robustness.

Suppliers are the entities, order lines the learners: the quantity gives the
level (tens), the return flag the grade, the line status the language.  The
nation is the municipality; its suppliers' balances are its fund.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import priority_band
from ..operators.counts import records_to_counts
from ..operators.keysets import (
    flag_members,
    keep_first,
    key_union,
    presence,
    presence_matrix,
    top_n_per_group,
)
from ..operators.ranks import exact_quantiles, percentile_ranks
from ..operators.robustness import (
    cutoff_overlap,
    random_weights,
    rank_correlations,
    rank_spread,
    ranks_by_draw,
    top_list_kendall,
)
from ..plans.chain import chain_progress
from ..plans.pairwise import pairwise_table
from ..plans.pipeline import export_all_pairs, net_gains_by_year
from ..plans.ranking import (
    NEED_WEIGHTS,
    area_capacity,
    complete_inputs,
    composite_inputs,
    coverage_funnel,
    pillar_scores,
    priority_list,
    rank_entities,
    ranking_summary,
    segment_inputs,
    tag_cohort,
    with_capacity,
)
from ..plans.reference import (
    REASON_FIELDS,
    reference_order,
    reference_table,
    validity_crosstab,
    with_reasons,
)
from ..plans.scoring import score_timepoints, weights_at
from ..plans.segments import make_segment, present_chain
from ..scales import Group, Instrument, Scale
from ..session import materialise
from .distributions import sql_validity
from .registry import query, r, rounded, scratch, sql_counts, sql_moments, sql_segments, sql_shares, table
from .segments import report_years, sql_chain_ctes, sql_reason

QUANTITY = Scale("quantity", ("1-10", "11-20", "21-30", "31-40", "41-50"))
SUPPLY = Instrument("supply", QUANTITY, tuple(Group(f, s) for f in ("A", "N", "R") for s in ("F", "O")))
SUPPLY_STRICT = 3
RANKED_YEARS = ("1999", "2000")


def supply_counts(spark, folder, year=None):
    """Lines, of one year if given, are counted under numbers for year and half-year; labels are written on the counts."""
    lines = table(spark, folder, "lineitem")
    if year is not None:
        first, after = (F.lit(f"{int(year) + n}-01-01").cast(lines.schema["l_shipdate"].dataType) for n in (0, 1))
        lines = lines.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < after))
    keys = [
        F.col("l_suppkey").alias("entity_id"),
        F.year("l_shipdate").alias("_year"),
        (F.month("l_shipdate") <= 6).alias("_first_half"),
        F.col("l_returnflag").alias("grade"),
        F.col("l_linestatus").alias("lang"),
    ]
    counts = records_to_counts(lines, keys, F.ceil(F.col("l_quantity") / 10), 5)
    counts = counts.withColumns({"school_year": F.col("_year").cast("string"), "period": F.when(F.col("_first_half"), "BoSY").otherwise("EoSY")})
    label = F.concat_ws(" ", "period", "school_year").alias("timepoint_label")
    return counts.select("entity_id", "school_year", "period", label, "grade", "lang", "counts")


def supply_scores(counts):
    scored = score_timepoints(counts, SUPPLY, ["entity_id", "timepoint_label"], scoring="ordinal", min_assessed=SUPPLY_STRICT)
    return scored.withColumnRenamed("derived_total", "total_assessed")


class SupplyChain:
    """Counts, written once, and chain progress over the timepoints they hold."""

    def __init__(self, spark, folder):
        self.counts = materialise(supply_counts(spark, folder))
        self.points, self.segments = present_chain(self.counts)
        self.progress = chain_progress(supply_scores(self.counts), "entity_id", self.points, self.segments, carry=REASON_FIELDS)
        self.number = {s.label: n for n, s in enumerate(self.segments, start=1)}

    def position(self, point):
        return self.points.index(point)

    def gains(self):
        return net_gains_by_year(self.counts, RANKED_YEARS)


def crosswalk(spark, folder):
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("entity_id"), F.col("s_nationkey").alias("area")
    )


def funds(spark, folder):
    suppliers = table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("area")).agg(
        F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("fund")
    )
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("area"), F.col("n_name").alias("area_name"))
    return suppliers.join(nations, "area")


def enrollment(spark, folder):
    return table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("entity_id")).agg(
        F.count(F.lit(1)).alias("enrolled")
    )


def capacity(spark, folder):
    return area_capacity(
        crosswalk(spark, folder), funds(spark, folder), "entity_id", "area", enrollment(spark, folder)
    )


def located(spark, folder, inputs):
    return with_capacity(inputs, crosswalk(spark, folder), capacity(spark, folder), "entity_id", "area")


def learning_inputs(spark, folder):
    chain = SupplyChain(spark, folder)
    inputs = segment_inputs(chain.progress, "entity_id", chain.number["Learning_2000"], chain.position("EoSY 2000"))
    return located(spark, folder, inputs)


TP_SQL = "concat_ws(' ', CASE WHEN month(l_shipdate) <= 6 THEN 'BoSY' ELSE 'EoSY' END, CAST(year(l_shipdate) AS VARCHAR))"
SUPPLY_KEYS = {"entity_id": "l_suppkey", "tp": TP_SQL, "grade": "l_returnflag", "lang": "l_linestatus"}
SUPPLY_LEVEL = "CAST(ceil(l_quantity / 10) AS INTEGER)"
SUPPLY_MOMENTS = (
    f"base AS ({sql_counts(SUPPLY_KEYS, SUPPLY_LEVEL, 5, 'lineitem')}), shares AS ({sql_shares('base')}), "
    f"moments AS ({sql_moments('shares')})"
)
SUPPLY_FLAGS = sql_validity(
    "shares", ["entity_id", "tp"], ["A", "N", "R"], [(f, s) for f in "ANR" for s in "FO"], 4, SUPPLY_STRICT
)


def sql_pick(grade: str) -> str:
    f, o = (f"coalesce(sum(CASE WHEN grade = '{grade}' AND lang = '{x}' THEN s END), 0)" for x in "FO")
    return f"CASE WHEN {f} > 0 THEN {f} ELSE {o} END"


SUPPLY_SEGMENTS = sql_segments(
    "lineitem", "CAST(year(l_shipdate) AS VARCHAR)", "CASE WHEN month(l_shipdate) <= 6 THEN 'BoSY' ELSE 'EoSY' END"
)
SUPPLY_CHAIN = sql_chain_ctes(
    SUPPLY_MOMENTS, SUPPLY_FLAGS, SUPPLY_SEGMENTS, total=" + ".join(sql_pick(g) for g in "ANR")
)
CAPACITY_SQL = """enrolled AS (SELECT s_nationkey AS area, CAST(count(*) AS DOUBLE) AS area_enrolled
    FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1),
  funds AS (SELECT s_nationkey AS area, n_name AS area_name,
    CAST(sum(CAST(s_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS fund
    FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2),
  capacity AS (SELECT funds.area, area_name, fund, area_enrolled, fund / area_enrolled AS fund_per_learner
    FROM funds LEFT JOIN enrolled USING (area))"""


GAIN_COLUMNS = [f"net_gain_{k}_{y}" for y in RANKED_YEARS for k in ("upper", "top")]
GAINS_SQL = "gains AS (SELECT entity_id, " + ", ".join(
    f"sum(CASE WHEN tp = 'EoSY {y}' THEN {cells} END) - sum(CASE WHEN tp = 'BoSY {y}' THEN {cells} END) AS net_gain_{k}_{y}"
    for y in RANKED_YEARS for k, cells in (("upper", "c4 + c5"), ("top", "c5"))
) + " FROM base GROUP BY entity_id)"


def sql_inputs(segments: list[str], end: str) -> str:
    """CTE inputs: rounded ranking inputs of entities strict in all segments."""
    joins = " ".join(
        f"JOIN (SELECT * FROM chain WHERE segment_label = '{s}' AND valid_strict) g{i} ON g{i}.entity_id = e.entity_id"
        for i, s in enumerate(segments)
    )
    n = float(len(segments))

    def average(column: str, zero: bool) -> str:
        parts = [f"coalesce(g{i}.{column}, 0)" if zero else f"g{i}.{column}" for i in range(len(segments))]
        return f"round(({' + '.join(parts)}) / {n}, 9)"

    zero = len(segments) > 1
    return f"""{SUPPLY_CHAIN}, {CAPACITY_SQL},
    inputs AS (SELECT e.entity_id, round(e.perf, 9) AS mean_end, round(e.sd, 9) AS sd_end, round(e.skew, 9) AS skew_end,
      {average('delta', False)} AS delta_mean, {average('sd_delta', zero)} AS delta_sd,
      {average('skew_delta', zero)} AS delta_skew, e.total AS assessed_count, area_name, fund_per_learner
      FROM (SELECT * FROM tf WHERE tp = '{end}') e {joins}
      LEFT JOIN supplier ON s_suppkey = e.entity_id LEFT JOIN capacity ON area = s_nationkey)"""


def sql_pctile(column: str) -> str:
    return (
        f"(rank() OVER (ORDER BY {column}) - 1 + (count(*) OVER (PARTITION BY {column}) + 1) / 2.0)"
        f" / count(*) OVER ()"
    )


def sql_z(column: str) -> str:
    return (
        f"CASE WHEN stddev_samp({column}) OVER () = 0 THEN 0.0 "
        f"ELSE ({column} - avg({column}) OVER ()) / stddev_samp({column}) OVER () END"
    )


NEED_SQL = " + ".join(f"{w} * z_{n}" for n, w in NEED_WEIGHTS.items())
PILLARS_SQL = f"""complete AS (SELECT * REPLACE (coalesce(sd_end, 0) AS sd_end, coalesce(skew_end, 0) AS skew_end,
    coalesce(delta_sd, 0) AS delta_sd, coalesce(delta_skew, 0) AS delta_skew),
    5 - mean_end AS need_level, -delta_mean AS need_delta, -fund_per_learner AS gap FROM inputs
    WHERE mean_end IS NOT NULL AND delta_mean IS NOT NULL AND assessed_count IS NOT NULL
      AND fund_per_learner IS NOT NULL),
  z AS (SELECT *, {sql_z('need_level')} AS z_level_mean, {sql_z('need_delta')} AS z_delta_mean,
    {sql_z('sd_end')} AS z_level_sd, {sql_z('skew_end')} AS z_level_skew, {sql_z('delta_sd')} AS z_delta_sd,
    {sql_z('delta_skew')} AS z_delta_skew, {sql_z('gap')} AS capacity_gap_score FROM complete),
  pillars AS (SELECT *, {NEED_SQL} AS need_score FROM z)"""
RANKED_SQL = f"""{PILLARS_SQL},
  p AS (SELECT *, {sql_pctile('need_score')} AS need_pctile, {sql_pctile('assessed_count')} AS impact_pctile,
    {sql_pctile('capacity_gap_score')} AS capacity_gap_pctile FROM pillars),
  s AS (SELECT *, need_pctile * impact_pctile * capacity_gap_pctile AS priority_score FROM p),
  ranked AS (SELECT *, {sql_pctile('priority_score')} AS priority_pctile FROM s)"""
BAND_SQL = """CASE WHEN priority_pctile >= 0.9 THEN '90th+' WHEN priority_pctile >= 0.7 THEN '70–90th'
  WHEN priority_pctile >= 0.5 THEN '50–70th' ELSE 'Below 50th' END AS priority_band"""
RANK_COLUMNS = (
    "mean_end", "sd_end", "skew_end", "delta_mean", "delta_sd", "delta_skew", "assessed_count", "fund_per_learner",
    "need_score", "capacity_gap_score", "need_pctile", "impact_pctile", "capacity_gap_pctile", "priority_score",
    "priority_pctile",
)
RANK_OUT = ", ".join(r(c, c) for c in RANK_COLUMNS)
LEARNING_SQL = sql_inputs(["Learning_2000"], "EoSY 2000")
TWO_YEAR_SQL = sql_inputs(["Learning_1999", "Learning_2000"], "EoSY 2000")


@query("zscore_need", f"""WITH {LEARNING_SQL}, {PILLARS_SQL}
SELECT entity_id, {', '.join(r(f'z_{n}', f'z_{n}') for n in NEED_WEIGHTS)}, {r('need_score', 'need_score')},
  {r('capacity_gap_score', 'capacity_gap_score')} FROM pillars""")
def zscore_need(spark, folder):
    base = materialise(complete_inputs(learning_inputs(spark, folder)))
    names = [f"z_{n}" for n in NEED_WEIGHTS]
    return rounded(pillar_scores(base).select("entity_id", *names, "need_score", "capacity_gap_score"))


@query("percentile_rank", f"""
WITH p AS (SELECT p_partkey, p_size, {sql_pctile('p_size')} AS size_pctile,
  {sql_pctile('p_retailprice')} AS price_pctile FROM part)
SELECT p_partkey, p_size, {r('size_pctile', 'size_pctile')}, {r('price_pctile', 'price_pctile')},
  {BAND_SQL.replace('priority_pctile', 'size_pctile')} FROM p""")
def percentile_rank(spark, folder):
    """Ranks of a heavily tied and of an almost untied column."""
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    ranked = percentile_ranks(parts, {"p_size": "size_pctile", "p_retailprice": "price_pctile"})
    return rounded(ranked.drop("p_retailprice").withColumn("priority_band", priority_band(F.col("size_pctile"))))


@query("percentile_rank_lines", f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {sql_pctile('l_quantity')} AS quantity_pctile FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {r('quantity_pctile', 'quantity_pctile')} FROM p""")
def percentile_rank_lines(spark, folder):
    """Ranks over the largest table; a quantity is shared by a fiftieth of all lines."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rounded(percentile_ranks(lines, {"l_quantity": "quantity_pctile"}))


@query("area_capacity", f"""WITH {CAPACITY_SQL}
SELECT area, area_name, {r('fund', 'fund')}, area_enrolled, {r('fund_per_learner', 'fund_per_learner')} FROM capacity""")
def area_capacity_query(spark, folder):
    return rounded(capacity(spark, folder))


@query("fund_fallback", """
WITH f AS (SELECT s_nationkey AS area, n_name AS area_name, CAST(count(*) AS DOUBLE) AS area_enrolled,
  CAST(sum(CAST(s_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS fund
  FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2)
SELECT area, area_name, round(fund, 6) + 0.0 AS fund, area_enrolled,
  round(fund / area_enrolled, 6) + 0.0 AS fund_per_learner FROM f""")
def fund_fallback(spark, folder):
    """Without enrollment the area's entities are the denominator."""
    return rounded(area_capacity(crosswalk(spark, folder), funds(spark, folder), "entity_id", "area"))


@query("priority_ranking", f"""WITH {LEARNING_SQL}, {RANKED_SQL}
SELECT entity_id, area_name, {RANK_OUT}, {BAND_SQL} FROM ranked""")
def priority_ranking(spark, folder):
    ranked = rank_entities(learning_inputs(spark, folder), "entity_id")
    return rounded(ranked.select("entity_id", "area_name", *RANK_COLUMNS, "priority_band"))


@query("composite_ranking", f"""WITH {TWO_YEAR_SQL}, {RANKED_SQL}, {GAINS_SQL}
SELECT entity_id, area_name, {RANK_OUT}, {BAND_SQL}, {', '.join(GAIN_COLUMNS)} FROM ranked LEFT JOIN gains USING (entity_id)""")
def composite_ranking(spark, folder):
    """Ranking over two years, with the net gains of both."""
    chain = SupplyChain(spark, folder)
    numbers = [chain.number[f"Learning_{y}"] for y in RANKED_YEARS]
    inputs = composite_inputs(chain.progress, "entity_id", numbers, chain.position("EoSY 2000"))
    ranked = rank_entities(located(spark, folder, inputs), "entity_id").join(chain.gains(), "entity_id", "left")
    return rounded(ranked.select("entity_id", "area_name", *RANK_COLUMNS, "priority_band", *GAIN_COLUMNS))


@query("ranking_summary", f"""WITH {LEARNING_SQL}
SELECT count(*) AS strict_valid,
  count(*) FILTER (WHERE mean_end IS NULL OR delta_mean IS NULL OR assessed_count IS NULL OR fund_per_learner IS NULL)
    AS dropped_missing_data,
  count(*) FILTER (WHERE mean_end IS NOT NULL AND delta_mean IS NOT NULL AND assessed_count IS NOT NULL
    AND fund_per_learner IS NOT NULL) AS ranked FROM inputs""")
def ranking_summary_query(spark, folder):
    return ranking_summary(learning_inputs(spark, folder))


def ranked_learning(spark, folder):
    return rank_entities(learning_inputs(spark, folder), "entity_id")


def cohort(spark, folder):
    """An earlier list: users who saw more value in errors than in purchases."""
    users = table(spark, folder, "events").groupBy(F.col("user_id").alias("entity_id")).agg(
        F.sum(F.when(F.col("event_type") == "error", F.col("value"))).alias("errors"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("purchases"),
    )
    return users.filter(F.col("errors") > F.col("purchases")).select("entity_id")


COHORT_SQL = """cohort AS (SELECT user_id AS entity_id FROM events GROUP BY user_id
  HAVING sum(CASE WHEN event_type = 'error' THEN value END) > sum(CASE WHEN event_type = 'purchase' THEN value END))"""


@query("cohort_compare", f"""WITH {LEARNING_SQL}, {RANKED_SQL}, {COHORT_SQL}
SELECT {BAND_SQL}, c.entity_id IS NOT NULL AS is_first_cycle, count(*) AS entities
FROM ranked LEFT JOIN cohort c USING (entity_id) GROUP BY 1, 2""")
def cohort_compare(spark, folder):
    """Bands of an earlier list in the current ranking."""
    tagged = tag_cohort(ranked_learning(spark, folder), cohort(spark, folder), "entity_id")
    return tagged.groupBy("priority_band", "is_first_cycle").agg(F.count(F.lit(1)).alias("entities"))


@query("cohort_matched", f"""WITH {LEARNING_SQL}, {RANKED_SQL}, {COHORT_SQL}
SELECT ranked.entity_id IS NOT NULL AS matched, count(*) AS entities
FROM cohort LEFT JOIN ranked USING (entity_id) GROUP BY 1""")
def cohort_matched(spark, folder):
    """How much of the earlier list is still ranked."""
    listed = flag_members(cohort(spark, folder), ranked_learning(spark, folder), "entity_id", "matched")
    return listed.groupBy("matched").agg(F.count(F.lit(1)).alias("entities"))


@query("priority_list", f"""WITH {LEARNING_SQL}, {RANKED_SQL}, {COHORT_SQL}
SELECT entity_id, {r('priority_score', 'priority_score')} FROM ranked
WHERE entity_id NOT IN (SELECT entity_id FROM cohort) ORDER BY ranked.priority_score DESC, entity_id LIMIT 100""")
def priority_list_query(spark, folder):
    """The hundred most urgent entities that were not in the earlier list."""
    top = priority_list(ranked_learning(spark, folder), "entity_id", 100, cohort(spark, folder))
    return rounded(top.select("entity_id", "priority_score"))


@query("topn_by_region", """
WITH x AS (SELECT c_nationkey, c_custkey, c_acctbal,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer)
SELECT c_nationkey, c_custkey, c_acctbal, CAST(n AS INTEGER) AS position FROM x WHERE n <= 10""")
def topn_by_region(spark, folder):
    customers = table(spark, folder, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return top_n_per_group(customers, "c_nationkey", [F.desc("c_acctbal"), F.asc("c_custkey")], 10)


@query("top_list_regions", """
WITH x AS (SELECT c_nationkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100)
SELECT r_name, count(*) AS entities FROM x JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""")
def top_list_regions(spark, folder):
    """Regions of the top hundred."""
    top = table(spark, folder, "customer").orderBy(F.desc("c_acctbal"), F.asc("c_custkey")).limit(100)
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    regions = table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return top.join(nations, "c_nationkey").join(regions, "n_regionkey").groupBy("r_name").agg(
        F.count(F.lit(1)).alias("entities")
    )


@query("top_and_bottom", """
SELECT 'top' AS side, c_custkey, c_acctbal FROM (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
UNION ALL
SELECT 'bottom', c_custkey, c_acctbal FROM (SELECT * FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10)""")
def top_and_bottom(spark, folder):
    """Both ends of a ranking, each found without a full sort."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    sides = {"top": F.desc("c_acctbal"), "bottom": F.asc("c_acctbal")}
    top, bottom = [
        customers.orderBy(order, F.asc("c_custkey")).limit(10).withColumn("side", F.lit(side))
        for side, order in sides.items()
    ]
    return top.unionByName(bottom)


DRAWS = random_weights(NEED_WEIGHTS, 500, seed=42)
DRAW_ROWS = ", ".join(f"({i}, {', '.join(str(d[n]) for n in NEED_WEIGHTS)})" for i, d in enumerate(DRAWS))
DRAW_NEED = " + ".join(f"CAST(w_{n} AS DOUBLE) * z_{n}" for n in NEED_WEIGHTS)


def sql_pctile_by(column: str, by: str) -> str:
    return (
        f"(rank() OVER (PARTITION BY {by} ORDER BY {column}) - 1"
        f" + (count(*) OVER (PARTITION BY {by}, {column}) + 1) / 2.0) / count(*) OVER (PARTITION BY {by})"
    )


@query("weight_sensitivity", f"""WITH {LEARNING_SQL}, {RANKED_SQL},
draws AS (SELECT * FROM (VALUES {DRAW_ROWS}) AS v(draw, {', '.join(f'w_{n}' for n in NEED_WEIGHTS)})),
d AS (SELECT entity_id, draw, impact_pctile, capacity_gap_pctile, round({DRAW_NEED}, 9) AS need FROM ranked, draws),
dp AS (SELECT entity_id, draw, {sql_pctile_by('need', 'draw')} * impact_pctile * capacity_gap_pctile AS score FROM d),
pos AS (SELECT entity_id, rank() OVER (PARTITION BY draw ORDER BY score DESC) AS position FROM dp)
SELECT entity_id, {r('quantile_cont(position, 0.5)', 'median_position')},
  {r('quantile_cont(position, 0.75) - quantile_cont(position, 0.25)', 'iqr')},
  min(position) AS best, max(position) AS worst,
  {r('avg(CASE WHEN position <= 20 THEN 1.0 ELSE 0.0 END)', 'top_share')} FROM pos GROUP BY entity_id""")
def weight_sensitivity(spark, folder):
    """Positions under many weightings of the need components."""
    scored = materialise(ranked_learning(spark, folder).drop("need_pctile", "priority_score", "priority_pctile"))
    return rounded(rank_spread(ranks_by_draw(scored, "entity_id", DRAWS), "entity_id", top=20))


@query("agreement", f"""WITH {LEARNING_SQL}, {RANKED_SQL}
SELECT 'need_score' AS metric, {r('corr(priority_pctile, need_pctile)', 'spearman')} FROM ranked UNION ALL
SELECT 'impact_score', {r('corr(priority_pctile, impact_pctile)', 'spearman')} FROM ranked UNION ALL
SELECT 'capacity_gap_score', {r('corr(priority_pctile, capacity_gap_pctile)', 'spearman')} FROM ranked""")
def agreement(spark, folder):
    """Rank correlation of each pillar with the composite."""
    ranked = materialise(ranked_learning(spark, folder).select(
        "priority_score", "need_score", "impact_score", "capacity_gap_score"
    ))
    return rounded(rank_correlations(ranked, "priority_score", ["need_score", "impact_score", "capacity_gap_score"]))


CUTOFFS = tuple(range(80, 151, 10))


@query("cutoff_overlap", f"""WITH {LEARNING_SQL}, {RANKED_SQL},
x AS (SELECT rank() OVER (ORDER BY priority_score DESC) AS a, rank() OVER (ORDER BY need_score DESC) AS b FROM ranked)
SELECT cutoff, count(*) FILTER (WHERE a <= cutoff AND b <= cutoff) AS common,
  count(*) FILTER (WHERE a <= cutoff) AS listed,
  {r('count(*) FILTER (WHERE a <= cutoff AND b <= cutoff) / count(*) FILTER (WHERE a <= cutoff)', 'overlap')}
FROM x, (VALUES {', '.join(f'({c})' for c in CUTOFFS)}) AS v(cutoff) GROUP BY cutoff""")
def cutoff_overlap_query(spark, folder):
    """Top lists of several lengths under two scores."""
    ranked = materialise(ranked_learning(spark, folder).select("priority_score", "need_score"))
    return rounded(cutoff_overlap(ranked, "priority_score", "need_score", CUTOFFS))


@query("top_list_kendall", """
WITH t AS (SELECT c_custkey, c_acctbal AS a, CAST(n AS DOUBLE) AS b FROM customer
  JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
  )
SELECT CAST(sqrt(count(*)) AS INTEGER) AS entities,
  round(sum(sign(x.a - y.a) * sign(x.b - y.b)) / (sqrt(count(*)) * (sqrt(count(*)) - 1)), 6) + 0.0 AS kendall
FROM t x, t y""")
def top_list_kendall_query(spark, folder):
    """Agreement of two orders over all customers."""
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n")
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal").join(orders, "c_custkey")
    return rounded(top_list_kendall(customers, "c_custkey", "c_acctbal", "n"))


@query("key_set_presence", """
WITH s AS (SELECT o_custkey AS entity_id, count(DISTINCT year(o_orderdate)) AS n FROM orders GROUP BY 1)
SELECT n AS timepoints_seen, count(*) AS entities FROM s GROUP BY n""")
def key_set_presence(spark, folder):
    """How many customers were seen in exactly one, two, ... years."""
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("entity_id"), F.year("o_orderdate").alias("yr"))
    return presence(orders, "entity_id", "yr").groupBy("timepoints_seen").agg(F.count(F.lit(1)).alias("entities"))


@query("key_set_ops", """
WITH k AS (SELECT o_custkey AS entity_id, bool_or(year(o_orderdate) = 1996) AS a, bool_or(year(o_orderdate) = 1997) AS b
  FROM orders GROUP BY 1)
SELECT count(*) FILTER (WHERE a AND b) AS in_both, count(*) FILTER (WHERE a AND NOT b) AS only_first,
  count(*) FILTER (WHERE b AND NOT a) AS only_second, count(*) FILTER (WHERE a OR b) AS in_either,
  count(*) FILTER (WHERE NOT a AND NOT b) AS in_neither FROM k""")
def key_set_ops(spark, folder):
    """Intersection, differences and union of two key sets, from one aggregation."""
    orders = table(spark, folder, "orders")
    year = F.year("o_orderdate")
    k = presence_matrix(orders.select(F.col("o_custkey").alias("entity_id"), "o_orderdate"), "entity_id", {
        "a": year == 1996, "b": year == 1997
    })
    a, b = F.col("in_a"), F.col("in_b")
    return k.agg(
        F.count_if(a & b).alias("in_both"),
        F.count_if(a & ~b).alias("only_first"),
        F.count_if(b & ~a).alias("only_second"),
        F.count_if(a | b).alias("in_either"),
        F.count_if(~a & ~b).alias("in_neither"),
    )


@query("key_union", """
SELECT o_custkey AS entity_id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT user_id FROM events""")
def key_union_query(spark, folder):
    frames = [
        table(spark, folder, t).select(F.col(c).alias("entity_id"))
        for t, c in (("orders", "o_custkey"), ("customer", "c_custkey"), ("events", "user_id"))
    ]
    return key_union(frames, "entity_id")


@query("keep_first", """
WITH x AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM x WHERE n = 1""")
def keep_first_query(spark, folder):
    """One order per customer, the earliest."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return keep_first(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


QUANTILES = (0.0, 0.05, 0.1, 0.15, 0.25, 0.5, 0.75, 1.0)


@query("quantile_summary", " UNION ALL ".join(
    f"SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST({q} AS DOUBLE) AS probability, "
    f"{r(f'quantile_cont(o_totalprice, {q})', 'quantile')} FROM orders GROUP BY 1" for q in QUANTILES
))
def quantile_summary(spark, folder):
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("yr"), "o_totalprice")
    return rounded(exact_quantiles(orders, "o_totalprice", QUANTILES, ["yr"]))


@query("pillar_summary", f"""
SELECT {r('avg(l_extendedprice)', 'mean')}, {r('stddev_samp(l_extendedprice)', 'sd')},
  {r('median(l_extendedprice)', 'median')} FROM lineitem""")
def pillar_summary(spark, folder):
    """Mean, deviation and exact median of a column; the median comes from its ladder."""
    prices = table(spark, folder, "lineitem").select("l_extendedprice")
    middle = exact_quantiles(prices, "l_extendedprice", [0.5]).select(F.col("quantile").alias("median"))
    totals = prices.agg(F.avg("l_extendedprice").alias("mean"), F.stddev_samp("l_extendedprice").alias("sd"))
    return rounded(totals.withColumn("median", middle.scalar()))


REFERENCE_SQL = f"""{SUPPLY_CHAIN}, {CAPACITY_SQL}, {COHORT_SQL}, {GAINS_SQL},
r1 AS ({sql_reason('1999', SUPPLY_STRICT)}),
r2 AS ({sql_reason('2000', SUPPLY_STRICT)}),
y1 AS (SELECT * FROM chain WHERE segment_label = 'Learning_1999'),
y2 AS (SELECT * FROM chain WHERE segment_label = 'Learning_2000'),
reference AS (SELECT y1.entity_id, s_name AS name, n_name AS area_name, fund_per_learner, {', '.join(GAIN_COLUMNS)},
  CASE WHEN y1.valid_strict THEN 'Yes' ELSE 'No' END AS valid_1999,
  CASE WHEN y2.valid_strict THEN 'Yes' ELSE 'No' END AS valid_2000,
  CASE WHEN y1.valid_strict AND y2.valid_strict THEN 'Yes' ELSE 'No' END AS valid_composite,
  CASE WHEN cohort.entity_id IS NOT NULL THEN 'Yes' ELSE '' END AS in_cohort,
  y1.delta AS delta_mean_1999, y2.delta AS delta_mean_2000,
  concat_ws(' | ', r1.reason, r2.reason) AS exclusion_reason
  FROM y1 JOIN y2 USING (entity_id) JOIN r1 USING (entity_id) JOIN r2 USING (entity_id)
  LEFT JOIN cohort ON cohort.entity_id = y1.entity_id LEFT JOIN gains ON gains.entity_id = y1.entity_id
  LEFT JOIN supplier ON s_suppkey = y1.entity_id LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN capacity ON capacity.area = s_nationkey)"""


def supply_reference(spark, folder):
    chain = SupplyChain(spark, folder)
    report = report_years(RANKED_YEARS, chain.segments)
    progress = with_reasons(chain.progress, report, chain.points, min_assessed=SUPPLY_STRICT)
    names = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("name"))
    named = located(spark, folder, progress).join(names, "entity_id", "left").join(chain.gains(), "entity_id", "left")
    return reference_table(
        named, "entity_id", report, cohort(spark, folder), ["name", "area_name", "fund_per_learner", *GAIN_COLUMNS]
    )


@query("reference_table", f"""WITH {REFERENCE_SQL}
SELECT * REPLACE (round(delta_mean_1999, 6) + 0.0 AS delta_mean_1999, round(delta_mean_2000, 6) + 0.0 AS delta_mean_2000,
  round(fund_per_learner, 6) + 0.0 AS fund_per_learner) FROM reference""")
def reference_table_query(spark, folder):
    return rounded(supply_reference(spark, folder).orderBy(*reference_order("name", "entity_id")))


@query("validity_crosstab", f"""WITH {REFERENCE_SQL}
SELECT valid_1999, valid_2000, count(*) AS entities, count(*) FILTER (WHERE in_cohort = 'Yes') AS in_cohort
FROM reference GROUP BY 1, 2""")
def validity_crosstab_query(spark, folder):
    return validity_crosstab(supply_reference(spark, folder), "valid_1999", "valid_2000")


@query("coverage_funnel", f"""WITH {SUPPLY_CHAIN}, {CAPACITY_SQL}
SELECT chain.segment_label, count(*) AS total, count(*) FILTER (WHERE chain.valid) AS valid,
  count(*) FILTER (WHERE chain.valid_strict) AS strict, count(delta) AS scored,
  count(*) FILTER (WHERE chain.valid_strict AND e.perf IS NOT NULL AND delta IS NOT NULL AND e.total IS NOT NULL
    AND fund_per_learner IS NOT NULL) AS ranked
FROM chain JOIN segs USING (seg_idx) LEFT JOIN tf e ON e.entity_id = chain.entity_id AND e.tp = tp1
LEFT JOIN supplier ON s_suppkey = chain.entity_id LEFT JOIN capacity ON area = s_nationkey
GROUP BY chain.segment_label""")
def coverage_funnel_query(spark, folder):
    """From all entities to valid, strict, scored and ranked ones, per segment."""
    chain = SupplyChain(spark, folder)
    return coverage_funnel(located(spark, folder, chain.progress), chain.points, chain.segments)


PAIR = make_segment(0, ("2000", "BoSY"), ("2000", "EoSY"))
PAIR_WEIGHTS = {"1-10": 0, "11-20": 13, "21-30": 42, "31-40": 77, "41-50": 100}
PAIR_ORDER = (2, 3, 1, 0, 4)


def sql_pair_side(alias: str, label: str) -> str:
    out = []
    for k in PAIR_ORDER:
        name = QUANTITY.levels[k]
        out.append(r(f"avg({alias}.p{k + 1})", f'"{label} {name} %"'))
        for g in SUPPLY.groups:
            out.append(r(
                f"max(CASE WHEN {alias}.grade = '{g.grade}' AND {alias}.lang = '{g.lang}' THEN {alias}.p{k + 1} END)",
                f'"{label} {g.label} {name}"',
            ))
        out.append(r(f"avg({alias}.p{k + 1}) * {PAIR_WEIGHTS[name]} / 100", f'"{label} {name} Weighted"'))
    return ", ".join(out)


@query("pairwise_wide", f"""WITH {SUPPLY_CHAIN},
a AS (SELECT entity_id, {sql_pair_side('shares', PAIR.start)} FROM shares WHERE tp = '{PAIR.start}' GROUP BY entity_id),
b AS (SELECT entity_id, {sql_pair_side('shares', PAIR.end)} FROM shares WHERE tp = '{PAIR.end}' GROUP BY entity_id),
ta AS (SELECT * FROM tf WHERE tp = '{PAIR.start}'), tb AS (SELECT * FROM tf WHERE tp = '{PAIR.end}'),
k AS (SELECT entity_id FROM ta UNION SELECT entity_id FROM tb),
f AS (SELECT k.entity_id, coalesce(ta.valid, false) AS va, coalesce(tb.valid, false) AS vb, ta.perf AS pa, tb.perf AS pb,
  coalesce(abs(tb.total - ta.total) / nullif(ta.total, 0) > 0.25, true) AS mm
  FROM k LEFT JOIN ta USING (entity_id) LEFT JOIN tb USING (entity_id))
SELECT f.entity_id, va AS "Has {PAIR.start} Data", vb AS "Has {PAIR.end} Data", mm AS "Student Count Mismatch",
  va AND vb AND NOT mm AS "Valid for Progress Analysis", {r('pa', f'"{PAIR.start} Performance"')},
  {r('pb', f'"{PAIR.end} Performance"')},
  {r('CASE WHEN va AND vb AND NOT mm THEN pb - pa END', '"Progress Score"')},
  a.* EXCLUDE (entity_id), b.* EXCLUDE (entity_id)
FROM f LEFT JOIN a USING (entity_id) LEFT JOIN b USING (entity_id)""")
def pairwise_wide(spark, folder):
    counts = materialise(supply_counts(spark, folder, year="2000"))
    return rounded(pairwise_table(counts, supply_scores(counts), SUPPLY, PAIR, weights=PAIR_WEIGHTS))


@query("pairwise_export", f"""WITH {SUPPLY_CHAIN},
a AS (SELECT seg_idx, entity_id, {sql_pair_side('shares', 'From')} FROM segs JOIN shares ON tp = tp0 GROUP BY seg_idx, entity_id),
b AS (SELECT seg_idx, entity_id, {sql_pair_side('shares', 'To')} FROM segs JOIN shares ON tp = tp1 GROUP BY seg_idx, entity_id),
ta AS (SELECT * FROM segs JOIN tf ON tp = tp0), tb AS (SELECT * FROM segs JOIN tf ON tp = tp1),
k AS (SELECT seg_idx, entity_id FROM ta UNION SELECT seg_idx, entity_id FROM tb),
f AS (SELECT seg_idx, entity_id, coalesce(ta.valid, false) AS va, coalesce(tb.valid, false) AS vb, ta.perf AS pa, tb.perf AS pb,
  coalesce(abs(tb.total - ta.total) / nullif(ta.total, 0) > 0.25, true) AS mm
  FROM k LEFT JOIN ta USING (seg_idx, entity_id) LEFT JOIN tb USING (seg_idx, entity_id))
SELECT segs.segment_label, segs.tp_from, segs.tp_to, f.entity_id, va AS "Has From Data", vb AS "Has To Data", mm AS "Student Count Mismatch",
  va AND vb AND NOT mm AS "Valid for Progress Analysis", {r('pa', '"From Performance"')}, {r('pb', '"To Performance"')},
  {r('CASE WHEN va AND vb AND NOT mm THEN pb - pa END', '"Progress Score"')},
  a.* EXCLUDE (seg_idx, entity_id), b.* EXCLUDE (seg_idx, entity_id)
FROM f JOIN segs USING (seg_idx) LEFT JOIN a USING (seg_idx, entity_id) LEFT JOIN b USING (seg_idx, entity_id)""")
def pairwise_export(spark, folder):
    """Every segment's pairwise table as CSV, written in one job and read back by its label."""
    counts = materialise(supply_counts(spark, folder))
    scores = supply_scores(counts)
    path, schema = export_all_pairs(counts, scores, SUPPLY, scratch(spark), "progress", weights=PAIR_WEIGHTS, metadata=())
    return rounded(spark.read.option("header", True).schema(schema).csv(path))


PCA_GROUPS = ", ".join(f"('{g.grade}', '{g.lang}', {i * 5})" for i, g in enumerate(SUPPLY.groups))
PCA_LEVELS = ", ".join(f"({i}, '{level}')" for i, level in enumerate(QUANTITY.levels))


@query("pca_weights", f"""
WITH RECURSIVE {SUPPLY_MOMENTS.rsplit(', moments AS', 1)[0]},
cells AS (SELECT entity_id, tp, first + k - 1 AS c, [p1, p2, p3, p4, p5][k] AS x
  FROM shares JOIN (VALUES {PCA_GROUPS}) g(grade, lang, first) USING (grade, lang), range(1, 6) t(k)),
complete AS (SELECT entity_id, tp FROM cells GROUP BY ALL HAVING count(x) = 30),
z AS (SELECT entity_id, tp, c, (x - avg(x) OVER w) / stddev_samp(x) OVER w AS z FROM cells JOIN complete USING (entity_id, tp)
  WINDOW w AS (PARTITION BY c)),
pairs AS (SELECT a.c AS i, b.c AS j, sum(a.z * b.z) AS v FROM z a JOIN z b USING (entity_id, tp) GROUP BY 1, 2),
matrix AS (SELECT list(line ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS line FROM pairs GROUP BY i)),
power AS (SELECT 0 AS step, [sin(i + 1.0) for i in range(30)] AS v
  UNION ALL
  SELECT step + 1, [x / sqrt(list_dot_product(y, y)) for x in y]
  FROM (SELECT step, list_transform(m, lambda line: list_dot_product(line, v)) AS y FROM power, matrix WHERE step < 3000)),
found AS (SELECT unnest(v) AS loading, generate_subscripts(v, 1) - 1 AS c FROM power WHERE step = 3000),
averaged AS (SELECT c % 5 AS k, avg(loading) AS x FROM found GROUP BY 1),
signed AS (SELECT k, x * CASE WHEN (SELECT x FROM averaged WHERE k = 4) < 0 THEN -1 ELSE 1 END AS x FROM averaged)
SELECT level, CAST(round(100 * (x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ())) AS INTEGER) AS weight, {r('x', 'loading')}
FROM signed JOIN (VALUES {PCA_LEVELS}) l(k, level) USING (k)""")
def pca_weights(spark, folder):
    """Level weights from the first principal component over all suppliers and timepoints."""
    counts = supply_counts(spark, folder)
    found = weights_at(counts, SUPPLY, ["entity_id", "timepoint_label"])
    rows = [(name, int(w), round(x, 6)) for name, w, x in zip(QUANTITY.levels, found.weights, found.loadings, strict=True)]
    return spark.createDataFrame(rows, "level string, weight int, loading double")


@query("group_null_rates", f"""WITH {SUPPLY_MOMENTS}
SELECT tp AS timepoint_label, {r('avg(CASE WHEN ordinal_skew IS NULL THEN 1.0 ELSE 0.0 END)', 'skew_missing')},
  {r('avg(CASE WHEN p1 IS NULL THEN 1.0 ELSE 0.0 END)', 'shares_missing')} FROM moments GROUP BY tp""")
def group_null_rates(spark, folder):
    from ..operators.moments import group_moments

    groups = group_moments(supply_counts(spark, folder), 5)
    return rounded(groups.groupBy("timepoint_label").agg(
        F.avg(F.col("ordinal_skew").isNull().cast("double")).alias("skew_missing"),
        F.avg(F.get("shares", F.lit(0)).isNull().cast("double")).alias("shares_missing"),
    ))
