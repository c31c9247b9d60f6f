"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, root)`` and returns a lazy DataFrame over the
whole input tables. Computed columns carry the same names as the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans import analytics as A
from starloom.plans.oracle import with_ctes
from starloom.plans.star import build_star, product_dimension, store_dimension
from starloom.schemas import CUSTOMER_SPEC
from starloom.sources import star_inputs as src
from starloom.sources.tables import Tables
from starloom.operators.calendar import calendar
from starloom.operators.scd import rebuild_history, replay_snapshots
from starloom.plans.star import order_date_span

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

# Q1 parameters: the half year reported as a crosstab (inside the data's span).
Q1_YEAR = 2000
Q1_MONTHS = A.half_year_months(Q1_YEAR, 1)
Q1_TOTAL = f"h1_{Q1_YEAR}_total"


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, oracle)
        return fn

    return deco


DIM_CUSTOMER_COLS = (
    "customer_key, customer_id, first_name, last_name, email, segment, city, region, "
    "valid_from, valid_to, is_current, version"
)


# --- dimensions -------------------------------------------------------------
@register("calendar_dim", with_ctes(["dim_date"], "select * from dim_date"))
def calendar_dim(spark: SparkSession, root: str) -> DataFrame:
    lo, hi = order_date_span(Tables(spark, root))
    return calendar(spark, lo, hi)


@register("product_dim", with_ctes(["f_dim_product"], "select * from f_dim_product"))
def product_dim(spark: SparkSession, root: str) -> DataFrame:
    return product_dimension(Tables(spark, root))


@register("store_dim", with_ctes(["f_dim_store"], "select * from f_dim_store"))
def store_dim(spark: SparkSession, root: str) -> DataFrame:
    return store_dimension(Tables(spark, root))


@register("scd2_merge", with_ctes(["f_dim_customer"], f"select {DIM_CUSTOMER_COLS} from f_dim_customer"))
def scd2_merge(spark: SparkSession, root: str) -> DataFrame:
    snaps = src.customer_snapshots(Tables(spark, root))
    return replay_snapshots(snaps, CUSTOMER_SPEC, dates=list(src.SNAPSHOT_DATES)).dimension


@register("scd2_rebuild", with_ctes(["f_dim_customer"], f"select {DIM_CUSTOMER_COLS} from f_dim_customer"))
def scd2_rebuild(spark: SparkSession, root: str) -> DataFrame:
    return rebuild_history(src.customer_snapshots(Tables(spark, root)), CUSTOMER_SPEC)


# --- fact ---------------------------------------------------------------------
@register("fact_resolve", with_ctes(["f_fact"], "select * from f_fact"))
def fact_resolve(spark: SparkSession, root: str) -> DataFrame:
    return build_star(spark, root, with_sale_key=True).fact


# --- analytics ------------------------------------------------------------------
_Q1_SQL = with_ctes(
    ["f_fact", "f_dim_product"],
    ", by_month as (select category, date_key // 100 as ym, sum(net_amount) as net\n"
    "  from f_fact join f_dim_product using (product_key) group by all)\nselect category, "
    + ", ".join(
        f"cast(round(any_value(net) filter (ym = {m.replace('-', '')}), 0) as bigint) as \"{m}\"" for m in Q1_MONTHS
    )
    + f", cast(round(sum(net), 0) as bigint) as {Q1_TOTAL}\n"
    f"from by_month where ym in ({', '.join(m.replace('-', '') for m in Q1_MONTHS)}) group by category",
)


@register("category_month", _Q1_SQL)
def category_month(spark: SparkSession, root: str) -> DataFrame:
    import datetime as dt

    first = dt.date.fromisoformat(Q1_MONTHS[0] + "-01")
    last_y, last_m = map(int, Q1_MONTHS[-1].split("-"))
    after = dt.date(last_y + (last_m == 12), last_m % 12 + 1, 1)
    star = build_star(spark, root, stg_from=first, stg_to=after)
    return A.category_month_revenue(star, Q1_MONTHS, Q1_TOTAL)


@register(
    "monthly_trend",
    with_ctes(
        ["f_fact", "dim_date"],
        """select strftime(full_date, '%Y-%m') as year_month, count(sale_key) as order_lines,
  cast(sum(quantity) as bigint) as units, cast(round(sum(net_amount), 0) as bigint) as net_revenue
from dim_date join f_fact using (date_key)
group by all order by all""",
    ),
)
def monthly_trend(spark: SparkSession, root: str) -> DataFrame:
    return A.monthly_trend(build_star(spark, root))


@register(
    "customer_history",
    with_ctes(
        ["f_dim_customer"],
        """, counted as (
  select *, max(version) over (partition by customer_id) as versions from f_dim_customer
), placed as (
  select *, dense_rank() over (order by customer_id) as place from counted where versions >= 2
)
select * exclude (first_name, last_name, email, versions, place) from placed where place <= 3""",
    ),
)
def customer_history(spark: SparkSession, root: str) -> DataFrame:
    return A.customer_history(rebuild_history(src.customer_snapshots(Tables(spark, root)), CUSTOMER_SPEC))


@register(
    "segment_pit_vs_current",
    with_ctes(
        ["f_segment_flow"],
        """, sums as (
  select seg, sum(net) filter (where side = 'then') as was, sum(net) filter (where side = 'now') as would_be
  from f_segment_flow unpivot (seg for side in (then_segment as 'then', now_segment as 'now'))
  group by seg
)
select seg as segment, cast(round(was, 0) as bigint) as net_revenue_point_in_time,
  cast(round(would_be, 0) as bigint) as net_revenue_restated_current,
  cast(round(would_be - was, 0) as bigint) as delta
from sums where was is not null and would_be is not null""",
    ),
)
def segment_pit_vs_current(spark: SparkSession, root: str) -> DataFrame:
    return A.segment_pit_vs_current(build_star(spark, root))


# The remaining registrations live beside their themes.
from starloom.plans import queries_load as _load  # noqa: E402,F401
from starloom.plans import queries_patterns as _patterns  # noqa: E402,F401
from starloom.plans import queries_stream as _stream  # noqa: E402,F401
from starloom.plans import queries_sql as _sql  # noqa: E402,F401
