"""Registry of queries, shared inputs, and building blocks of the SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counts import records_to_counts, sum_counts
from ..scales import Group, Instrument, Scale
from ..session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` and its SQL twin."""

    def register(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def scratch(spark: SparkSession) -> str:
    """A new folder next to the checkpoints, which all executors can reach."""
    return f"{ensure_checkpoint_dir(spark)}/stratalens-{uuid.uuid4().hex}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double; adding zero turns a negative zero into zero."""
    return df.select(*[
        (F.round(F.col(f"`{n}`"), digits) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


def r(expression: str, alias: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"round({expression}, {digits}) + 0.0 AS {alias}"


# The roles the test tables play: orders are learners, the order priority is the
# level, the customer's market segment is the grade, the order status the language.
PRIORITY = Scale("priority", ("URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"))
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STATUSES = ("F", "O", "P")
SALES = Instrument("sales", PRIORITY, tuple(Group(s) for s in SEGMENTS))
SALES_BY_STATUS = Instrument("sales_by_status", PRIORITY, tuple(Group(s, o) for s in SEGMENTS for o in STATUSES))


def priority_level() -> Column:
    return F.substring("o_orderpriority", 1, 1).try_cast("int")


def weekday_level() -> Column:
    return F.dayofweek("o_orderdate")


def order_year() -> Column:
    return F.year("o_orderdate").cast("string")


def order_period() -> Column:
    return F.when(F.month("o_orderdate") <= 6, "BoSY").otherwise("EoSY")


def line_timepoints(spark, folder) -> DataFrame:
    """(school_year, period) of every order line, by its ship date."""
    period = F.when(F.month("l_shipdate") <= 6, "BoSY").otherwise("EoSY")
    return table(spark, folder, "lineitem").select(F.year("l_shipdate").cast("string").alias("school_year"), period.alias("period"))


def customer_counts(spark, folder, keys: dict[str, Column], level: Column | None = None, size: int = 5) -> DataFrame:
    """Order counts per customer and further keys of the order."""
    orders = table(spark, folder, "orders")
    level = priority_level() if level is None else level
    return records_to_counts(
        orders, [F.col("o_custkey").alias("entity_id"), *[c.alias(n) for n, c in keys.items()]], level, size
    )


def nation_counts(spark, folder, keys: dict[str, Column], level: Column | None = None, size: int = 5) -> DataFrame:
    """Order counts per nation, market segment and further keys of the order.

    Orders are counted per customer before the join, so that the join moves
    counts and a customer with very many orders is a few rows.
    """
    per_customer = customer_counts(spark, folder, keys, level, size).withColumnRenamed("entity_id", "c_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = per_customer.join(customers, "c_custkey").select(
        F.col("c_nationkey").cast("bigint").alias("entity_id"), F.col("c_mktsegment").alias("grade"), *keys, "counts"
    )
    return sum_counts(joined, ["entity_id", "grade", *keys], size)


def sales_counts(spark, folder) -> DataFrame:
    """Nation × year × half-year × market segment, in the shape of a lake table."""
    counts = nation_counts(spark, folder, {"school_year": order_year(), "period": order_period()})
    return counts.withColumn("lang", F.lit(None).cast("string"))


def sales_by_status(spark, folder) -> DataFrame:
    """Nation × year × half-year × market segment × order status."""
    keys = {"school_year": order_year(), "period": order_period(), "lang": F.col("o_orderstatus")}
    return nation_counts(spark, folder, keys)


SQL_LEVEL = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
SQL_WEEKDAY = "(dayofweek(o_orderdate) + 1)"
SQL_YEAR = "CAST(year(o_orderdate) AS VARCHAR)"
SQL_PERIOD = "CASE WHEN month(o_orderdate) <= 6 THEN 'BoSY' ELSE 'EoSY' END"
SQL_ORDERS = "orders JOIN customer ON o_custkey = c_custkey"


def sql_counts(keys: dict[str, str], level: str = SQL_LEVEL, size: int = 5, source: str = SQL_ORDERS) -> str:
    """Level counts c1..cK per key."""
    cells = ", ".join(
        f"CAST(count(*) FILTER (WHERE {level} = {i}) AS DOUBLE) AS c{i}" for i in range(1, size + 1)
    )
    names = ", ".join(f"{e} AS {n}" for n, e in keys.items())
    positions = ", ".join(str(i + 1) for i in range(len(keys)))
    return f"SELECT {names}, {cells} FROM {source} GROUP BY {positions}"


def sql_shares(source: str, size: int = 5) -> str:
    """Percentages p1..pK of the group's sum s."""
    total = " + ".join(f"coalesce(c{i}, 0)" for i in range(1, size + 1))
    cells = ", ".join(f"CASE WHEN s > 0 THEN c{i} / s * 100 END AS p{i}" for i in range(1, size + 1))
    return f"SELECT *, {cells} FROM (SELECT *, {total} AS s FROM {source})"


def sql_segments(source: str, year: str, period: str) -> str:
    """CTEs up to ``segs``: all segments of the timepoints that a table holds."""
    rank = "CASE p WHEN 'BoSY' THEN 0 WHEN 'MoSY' THEN 1 ELSE 2 END"
    return f"""tps AS (SELECT DISTINCT {year} AS y, {period} AS p FROM {source}),
    placed AS (SELECT y, p, row_number() OVER w AS i, lead(p) OVER w AS following, count(*) OVER (PARTITION BY y) AS n,
      last_value(p) OVER (PARTITION BY y ORDER BY {rank} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final
      FROM tps WINDOW w AS (PARTITION BY y ORDER BY {rank})),
    pairs AS (SELECT y AS y0, p AS p0, y AS y1, following AS p1, 0 AS section, i FROM placed WHERE following IS NOT NULL
      UNION ALL SELECT y, p, y, final, 0, 99 FROM placed WHERE i = 1 AND n > 2
      UNION ALL SELECT min(y), p, max(y), p, CASE p WHEN 'BoSY' THEN 1 ELSE 2 END, 0 FROM tps WHERE p IN ('BoSY', 'EoSY')
        GROUP BY p HAVING min(y) <> max(y)
      UNION ALL SELECT min(y) FILTER (WHERE p = 'BoSY'), 'BoSY', max(y) FILTER (WHERE p = 'EoSY'), 'EoSY', 3, 0 FROM tps
        HAVING min(y) FILTER (WHERE p = 'BoSY') <> max(y) FILTER (WHERE p = 'EoSY')),
    segs AS (SELECT CAST(row_number() OVER (ORDER BY section, y0, i) - 1 AS INTEGER) AS seg_idx,
      CASE WHEN y0 = y1 AND p0 = 'BoSY' AND p1 = 'EoSY' THEN 'Learning_' || y0 WHEN y0 = y1 THEN p0 || p1 || '_' || y0
        WHEN p0 = p1 THEN 'YoY_' || p0 || '_' || y0 || '_to_' || y1 ELSE 'EndToEnd_' || y0 || '_to_' || y1 END AS segment_label,
      CASE WHEN y0 = y1 THEN 'within_year' WHEN p0 = p1 THEN 'year_over_year' ELSE 'end_to_end' END AS segment_kind,
      p0 || ' ' || y0 AS tp0, p1 || ' ' || y1 AS tp1, p0 || ' ' || y0 AS tp_from, p1 || ' ' || y1 AS tp_to FROM pairs)"""


def sql_learning(source: str, year: str, period: str) -> str:
    """CTE ``segs``: begin to end of each year that has both."""
    return f"""segs AS (SELECT CAST(row_number() OVER (ORDER BY y) - 1 AS INTEGER) AS seg_idx, 'Learning_' || y AS segment_label,
      'within_year' AS segment_kind, 'BoSY ' || y AS tp0, 'EoSY ' || y AS tp1, 'BoSY ' || y AS tp_from, 'EoSY ' || y AS tp_to
      FROM (SELECT {year} AS y FROM {source} GROUP BY 1 HAVING count(DISTINCT {period}) = 2))"""


def sql_steps(source: str, point: str) -> str:
    """CTE ``segs``: neighbours of the distinct values of a column."""
    return f"""segs AS (SELECT CAST(row_number() OVER (ORDER BY y) - 1 AS INTEGER) AS seg_idx, 'Step_' || y || '_to_' || n AS segment_label,
      'step' AS segment_kind, y AS tp0, n AS tp1, y AS tp_from, n AS tp_to
      FROM (SELECT y, lead(y) OVER (ORDER BY y) AS n FROM (SELECT DISTINCT {point} AS y FROM {source})) WHERE n IS NOT NULL)"""


def sql_moments(source: str, size: int = 5, null_all: bool = False) -> str:
    """Moments of the shares in ``source``, one row per group."""
    n = range(1, size + 1)
    mean = "(" + " + ".join(f"p{i} * {i}.0" for i in n) + ") / 100"

    def central(power: int) -> str:
        return "(" + " + ".join(f"p{i} * power({i} - m, {power})" for i in n) + ") / 100"

    keep = "CASE WHEN sd > 0 THEN {} END" if null_all else "{}"
    return f"""
    SELECT * EXCLUDE (m, sd, m3, m4), {keep.format('m')} AS ordinal_mean, {keep.format('sd')} AS ordinal_sd,
      CASE WHEN sd > 0 THEN m3 / power(sd, 3) END AS ordinal_skew,
      CASE WHEN sd > 0 THEN m4 / power(sd, 4) - 3 END AS ordinal_kurt,
      CASE WHEN sd > 0 THEN (power(m3 / power(sd, 3), 2) + 1) / (m4 / power(sd, 4)) END AS bimodality_coef
    FROM (SELECT *, sqrt({central(2)}) AS sd, {central(3)} AS m3, {central(4)} AS m4
          FROM (SELECT *, {mean} AS m FROM {source}))"""


def sql_emd(a: str, b: str, size: int = 5) -> str:
    """Earth mover's distance of the shares of two aliases."""
    terms = []
    for k in range(1, size):
        inner = " + ".join(f"({a}.p{i} - {b}.p{i})" for i in range(1, k + 1))
        terms.append(f"abs({inner})")
    return "(" + " + ".join(terms) + ") / 100"


SQL_MOMENT_AVERAGES = ", ".join(
    r(f"avg({m})", m) for m in ("ordinal_mean", "ordinal_sd", "ordinal_skew", "ordinal_kurt", "bimodality_coef")
)
