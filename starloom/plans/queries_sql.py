"""Registered SQL-text forms of the four star-schema questions.

The SQL is plain text run by Spark SQL over :func:`register_views`; the
oracle is the same SQL over the oracle's CTE star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.plans.oracle import with_ctes
from starloom.plans.registry import Q1_MONTHS, Q1_TOTAL, register
from starloom.plans.sql import register_views, run_query
from starloom.plans.star import build_star

# Each text aggregates the fact on its own keys first and joins the few
# resulting rows, which is how one would write it for a large fact.
_Q1 = (
    """with monthly as (
  select product_key, cast(floor(date_key / 100) as int) as month_no, sum(net_amount) as net
  from fact_sales
  where date_key between {first}01 and {last}31
  group by product_key, cast(floor(date_key / 100) as int)
)
select category""".format(first=Q1_MONTHS[0].replace("-", ""), last=Q1_MONTHS[-1].replace("-", ""))
    + "".join(
        ",\n  cast(round(sum(case when month_no = {no} then net end), 0) as bigint) as \"{m}\"".format(
            no=m.replace("-", ""), m=m
        )
        for m in Q1_MONTHS
    )
    + f""",
  cast(round(sum(net), 0) as bigint) as {Q1_TOTAL}
from monthly inner join dim_product using (product_key)
group by category
order by {Q1_TOTAL} desc, category"""
)

_Q2 = """with daily as (
  select date_key, count(*) as n, sum(quantity) as pieces, sum(net_amount) as net
  from fact_sales group by date_key
)
select year_month, cast(sum(n) as bigint) as order_lines, cast(sum(pieces) as bigint) as units,
  cast(round(sum(net), 0) as bigint) as net_revenue
from dim_date inner join daily using (date_key)
group by year_month
order by year_month"""

# a member with history is one that has a second version
_Q3_CTE = """changed as (
  select customer_id as id from dim_customer where version = 2 order by id limit 3
)"""
_Q3_BODY = """select customer_key, customer_id, segment, city, region, valid_from, valid_to, is_current, version
from dim_customer where exists (select 1 from changed where id = customer_id)
order by customer_id, version"""

# one pass over the fact: money flows from the segment then to the segment now
_Q4_CTES = """tagged as (
  select customer_key, segment as then_segment,
    max(case when is_current then segment end) over (partition by customer_id) as now_segment
  from dim_customer
), flows as (
  select then_segment, now_segment, sum(net_amount) as net
  from fact_sales inner join tagged using (customer_key)
  group by then_segment, now_segment
), sides as (
  select then_segment as segment, net as booked, cast(null as decimal(38, 2)) as moved from flows
  union all
  select now_segment, cast(null as decimal(38, 2)), net from flows
)"""
_Q4_BODY = """select segment,
  cast(round(sum(booked), 0) as bigint) as net_revenue_point_in_time,
  cast(round(sum(moved), 0) as bigint) as net_revenue_restated_current,
  cast(round(sum(moved) - sum(booked), 0) as bigint) as delta
from sides
group by segment
having segment is not null and count(booked) > 0 and count(moved) > 0
order by segment"""


def _oracle(sql: str) -> str:
    """The same text over the oracle's star (its CTE names differ)."""
    return (
        sql.replace("fact_sales", "f_fact")
        .replace("dim_product", "f_dim_product")
        .replace("dim_customer", "f_dim_customer")
    )


def _run(spark: SparkSession, root: str, sql: str) -> DataFrame:
    register_views(build_star(spark, root))
    return run_query(spark, sql)


@register("sql_category_month", with_ctes(["f_fact", "f_dim_product"], _oracle(_Q1).replace("with ", ", ", 1)))
def sql_category_month(spark: SparkSession, root: str) -> DataFrame:
    return _run(spark, root, _Q1)


@register("sql_monthly_trend", with_ctes(["f_fact", "dim_date"], _oracle(_Q2).replace("with ", ", ", 1)))
def sql_monthly_trend(spark: SparkSession, root: str) -> DataFrame:
    return _run(spark, root, _Q2)


@register(
    "sql_customer_history",
    with_ctes(["f_dim_customer"], ", " + _oracle(_Q3_CTE) + "\n" + _oracle(_Q3_BODY)),
)
def sql_customer_history(spark: SparkSession, root: str) -> DataFrame:
    return _run(spark, root, "with " + _Q3_CTE + "\n" + _Q3_BODY)


@register(
    "sql_segment_pit_vs_current",
    with_ctes(["f_fact", "f_dim_customer"], ", " + _oracle(_Q4_CTES) + "\n" + _oracle(_Q4_BODY)),
)
def sql_segment_pit_vs_current(spark: SparkSession, root: str) -> DataFrame:
    return _run(spark, root, "with " + _Q4_CTES + "\n" + _Q4_BODY)
