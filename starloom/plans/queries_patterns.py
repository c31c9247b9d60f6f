"""Registered modelling-pattern queries (tier D): drill-across, conformed
rollups, conformance, ratios, semi-additive and snapshot facts, decoding and
bands, snowflake/outrigger, bounded reloads and the partitioned fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import year_month
from starloom.functions.money import exact_sum
from starloom.operators import checks as C
from starloom.operators import conform, facts, measures
from starloom.operators.asof import lookup_key
from starloom.operators.calendar import month_dimension
from starloom.operators.scd import rebuild_history
from starloom.plans import snapshots
from starloom.plans.oracle import with_ctes
from starloom.plans.registry import register
from starloom.plans.star import build_star
from starloom.plans.warehouse import fact_by_month, read_fact, reload_window, write_fact
from starloom.schemas import CUSTOMER_SPEC, FACT_SALES_COLUMNS
from starloom.session import cut_lineage, scratch_path
from starloom.sources import star_inputs as src
from starloom.sources.tables import Tables

_FACT_DATE_PRODUCT = "from f_fact f join dim_date d using (date_key) join f_dim_product p using (product_key)"


# --- D8 drill-across ----------------------------------------------------------------
@register(
    "drill_across",
    with_ctes(
        ["f_fact", "dim_date", "f_dim_product"],
        f""", s as (
  select p.category, cast(d.year as int) as year, count(*) as sales_lines, sum(f.net_amount) as sales_net
  {_FACT_DATE_PRODUCT} group by p.category, d.year
), r as (
  select p.category, cast(year(o_orderdate) as int) as year, count(*) as return_lines,
    sum(cast(l_extendedprice as decimal(12,2))) as returns_gross
  from lineitem join orders on l_orderkey = o_orderkey join f_dim_product p on p.product_id = l_partkey
  where l_returnflag = 'R' group by p.category, year(o_orderdate)
)
select coalesce(s.category, r.category) as category, coalesce(s.year, r.year) as year,
  s.sales_lines, cast(s.sales_net as decimal(38,2)) as sales_net,
  r.return_lines, cast(r.returns_gross as decimal(38,2)) as returns_gross
from s full outer join r on s.category = r.category and s.year = r.year""",
    ),
)
def drill_across(spark: SparkSession, root: str) -> DataFrame:
    """Sales and returns aggregated apart, aligned on conformed attributes."""
    star = build_star(spark, root)
    sales = (
        star.fact.join(star.date_dim("date_key", "year"), "date_key")
        .join(star.dim("product", "product_key", "category"), "product_key")
        .groupBy("category", F.col("year").cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("sales_lines"), exact_sum("net_amount").alias("sales_net"))
    )
    rets = lookup_key(
        src.staged_returns(star.tables),
        star.dim_product,
        "product_id",
        "product_id",
        "product_key",
        broadcast="product" in star.broadcastable,
    )
    returns = (
        rets.join(star.dim("product", "product_key", "category"), "product_key")
        .groupBy("category", F.year("order_date").alias("year"))
        .agg(F.count(F.lit(1)).alias("return_lines"), exact_sum("returned_gross").alias("returns_gross"))
    )
    return conform.drill_across(sales, returns, ["category", "year"])


# --- D9 / D18 month rollup and pre-aggregate --------------------------------------------
_PREAGG_SQL = f"""select d.year_month, p.category, count(*) as order_lines, cast(sum(f.quantity) as bigint) as units,
  cast(sum(f.gross_amount) as decimal(38,2)) as gross_amount, cast(sum(f.net_amount) as decimal(38,2)) as net_amount
{_FACT_DATE_PRODUCT} group by d.year_month, p.category"""


@register("preaggregate", with_ctes(["f_fact", "dim_date", "f_dim_product"], _PREAGG_SQL))
def preaggregate(spark: SparkSession, root: str) -> DataFrame:
    """Month x category aggregate kept beside the atomic fact."""
    star = build_star(spark, root)
    return facts.preaggregate(star.fact, star.date_dim("date_key", "year_month"), star.dim("product", "product_key", "category"))


@register("preaggregate_incremental", with_ctes(["f_fact", "dim_date", "f_dim_product"], _PREAGG_SQL))
def preaggregate_incremental(spark: SparkSession, root: str) -> DataFrame:
    """D18 kept up by loads: the stored sums after a load with a damaged window, and
    the reload of that window, which adds up its own months only."""
    from starloom.plans import warehouse as W

    t, out = Tables(spark, root), scratch_path(spark, "rollup-warehouse")
    W.write_static_dimensions(spark, t, out)
    snaps = src.customer_snapshots(t)
    for day in src.SNAPSHOT_DATES:
        W.merge_into(spark, f"{out}/dim_customer", snaps.where(F.col("as_of") == F.lit(day)), day, CUSTOMER_SPEC, seed=True)
    stg = cut_lineage(src.staged_sales(t), "staged")
    span = stg.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    first, last = RELOAD_FIRST + dt.timedelta(days=10), RELOAD_LAST + dt.timedelta(days=10)
    inside = F.col("order_date").between(F.lit(first), F.lit(last))
    W.load_increment(spark, out, stg.where(~inside | (F.col("quantity") < 25)), span["lo"], span["hi"])
    W.load_increment(spark, out, stg.where(inside), first, last)
    return W.read_rollup(spark, f"{out}/fact_sales")


@register(
    "preaggregate_reconciles",
    with_ctes(
        ["f_fact", "dim_date", "f_dim_product"],
        f""", pa as ({_PREAGG_SQL})
select 'atomic_net' as metric, cast(sum(net_amount) as decimal(38,2)) as value from f_fact
union all select 'rollup_net', cast(sum(net_amount) as decimal(38,2)) from pa
union all select 'atomic_lines', cast(count(*) as decimal(38,2)) from f_fact
union all select 'rollup_lines', cast(sum(order_lines) as decimal(38,2)) from pa""",
    ),
)
def preaggregate_reconciles(spark: SparkSession, root: str) -> DataFrame:
    """D18 check: the pre-aggregate sums back to the atomic fact, in one scan."""
    star = build_star(spark, root)
    measures_ = ["quantity", "gross_amount", "net_amount"]
    lines = C.with_total(star.fact, ["date_key", "product_key"], measures_)
    months, cats = star.date_dim("date_key", "year_month"), star.dim("product", "product_key", "category")
    rolled = facts.preaggregate(lines, months, cats, "left", (C.TOTAL,))
    total = F.col(C.TOTAL)
    kept = ~total & F.col("year_month").isNotNull() & F.col("category").isNotNull()
    return C.measured(
        rolled,
        atomic_net=F.sum(F.when(total, F.col("net_amount"))),
        rollup_net=F.sum(F.when(kept, F.col("net_amount"))),
        atomic_lines=F.sum(F.when(total, F.col("order_lines"))),
        rollup_lines=F.sum(F.when(kept, F.col("order_lines"))),
    )


@register(
    "month_rollup",
    with_ctes(
        ["f_fact", "dim_date", "f_dim_product"],
        f""", m as (
  select year_month, min(year) as year, min(quarter) as quarter, min(month_number) as month_number,
    min(month_name) as month_name, cast(year(min(full_date)) * 100 + month(min(full_date)) as int) as month_key,
    cast(count(*) as int) as days_in_month
  from dim_date group by year_month
), pa as ({_PREAGG_SQL})
select m.year_month, m.year, m.quarter, m.month_number, m.month_name, m.month_key, m.days_in_month,
  pa.category, pa.order_lines, pa.units, pa.net_amount
from pa join m on pa.year_month = m.year_month""",
    ),
)
def month_rollup(spark: SparkSession, root: str) -> DataFrame:
    """A month-grain fact described by the conformed month dimension."""
    star = build_star(spark, root)
    pa = facts.preaggregate(star.fact, star.date_dim("date_key", "year_month"), star.dim("product", "product_key", "category"))
    months = month_dimension(star.dim_date)
    return pa.join(F.broadcast(months), "year_month").select(
        "year_month",
        "year",
        "quarter",
        "month_number",
        "month_name",
        "month_key",
        "days_in_month",
        "category",
        "order_lines",
        "units",
        "net_amount",
    )


# --- D10 / D11 conformance ---------------------------------------------------------------
@register(
    "conformance",
    with_ctes(
        ["f_dim_store", "f_dim_customer"],
        """, a as (select distinct city, region as store_region from f_dim_store),
b as (select distinct city, region as customer_region from f_dim_customer)
select coalesce(a.city, b.city) as city, a.store_region, b.customer_region,
  case when a.store_region is null then 'customer_only'
       when b.customer_region is null then 'store_only'
       when a.store_region = b.customer_region then 'conformed' else 'conflict' end as status
from a full outer join b on a.city = b.city""",
    ),
)
def conformance(spark: SparkSession, root: str) -> DataFrame:
    """City -> region must agree between the store and customer dimensions."""
    star = build_star(spark, root)
    return conform.conformance(star.dim_store, star.dim_customer, "city", "region", "store", "customer")


@register(
    "region_two_ways",
    with_ctes(
        ["f_fact", "f_dim_store", "f_dim_customer"],
        """, s as (
  select t.region, sum(f.net_amount) as net_by_store_region from f_fact f
  join f_dim_store t on f.store_key = t.store_key group by t.region
), c as (
  select c.region, sum(f.net_amount) as net_by_customer_region from f_fact f
  join f_dim_customer c on f.customer_key = c.customer_key group by c.region
)
select coalesce(s.region, c.region) as region,
  cast(s.net_by_store_region as decimal(38,2)) as net_by_store_region,
  cast(c.net_by_customer_region as decimal(38,2)) as net_by_customer_region
from s full outer join c on s.region = c.region""",
    ),
)
def region_two_ways(spark: SparkSession, root: str) -> DataFrame:
    """Revenue by the store's region versus the customer's region then."""
    star = build_star(spark, root)
    # one scan: sums by store and by customer version, then each meets its dimension
    sides = star.fact.groupingSets([["store_key"], ["customer_key"]], "store_key", "customer_key").agg(
        F.sum("net_amount").alias("_net"), (F.grouping("store_key") == 0).alias("_of_store")
    )
    stores = star.dim("store", "store_key", F.col("region").alias("_store_region"))
    customers = star.dim("customer", "customer_key", F.col("region").alias("_customer_region"))
    met = sides.join(stores, "store_key", "left").join(customers, "customer_key", "left")
    region = F.when(F.col("_of_store"), F.col("_store_region")).otherwise(F.col("_customer_region"))
    return (
        met.select(region.alias("region"), "_of_store", "_net")
        .where(F.col("region").isNotNull())
        .groupBy("region")
        .agg(
            F.sum(F.when(F.col("_of_store"), F.col("_net"))).cast("decimal(38,2)").alias("net_by_store_region"),
            F.sum(F.when(~F.col("_of_store"), F.col("_net"))).cast("decimal(38,2)").alias("net_by_customer_region"),
        )
    )


# --- D12 / D13 ratios -----------------------------------------------------------------------
@register(
    "ratio_of_sums",
    with_ctes(
        ["f_fact", "f_dim_product"],
        """select p.category,
  cast(sum(f.net_amount) as double) / cast(sum(f.quantity) as double) as net_per_unit,
  cast(sum(f.unit_price) as double) / cast(count(*) as double) as avg_list_price,
  cast(sum(f.quantity) as bigint) as units
from f_fact f join f_dim_product p on f.product_key = p.product_key group by p.category""",
    ),
)
def ratio_of_sums(spark: SparkSession, root: str) -> DataFrame:
    """Price per unit as a ratio of sums."""
    star = build_star(spark, root)
    lines = star.fact.join(star.dim("product", "product_key", "category"), "product_key")
    return measures.ratio_of_sums(lines, ["category"])


@register(
    "slice_discount",
    with_ctes(
        ["f_fact", "f_dim_product", "dim_date"],
        f"""select p.category, d.year_month,
  1.0 - cast(sum(f.net_amount) as double) / cast(sum(f.gross_amount) as double) as effective_discount,
  cast(sum(f.discount_pct) as double) / cast(count(*) as double) as avg_line_discount,
  count(*) as order_lines
{_FACT_DATE_PRODUCT} group by p.category, d.year_month""",
    ),
)
def slice_discount(spark: SparkSession, root: str) -> DataFrame:
    """Effective discount of every (category, month) slice."""
    star = build_star(spark, root)
    lines = star.fact.join(star.date_dim("date_key", "year_month"), "date_key").join(
        star.dim("product", "product_key", "category"), "product_key"
    )
    return measures.slice_discount(lines, ["category", "year_month"])


# --- D14 order rollup, A4 distinct orders ------------------------------------------------------
@register(
    "order_rollup",
    with_ctes(
        ["f_fact"],
        """select order_id, count(*) as order_lines, cast(sum(quantity) as bigint) as units,
  cast(sum(gross_amount) as decimal(38,2)) as gross_amount, cast(sum(net_amount) as decimal(38,2)) as net_amount
from f_fact group by order_id""",
    ),
)
def order_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Order lines rolled up through the degenerate order_id."""
    return facts.order_rollup(build_star(spark, root).fact)


@register(
    "distinct_orders",
    with_ctes(
        ["f_fact", "dim_date"],
        """select d.year_month, count(distinct f.order_id) as orders, count(*) as order_lines
from f_fact f join dim_date d on f.date_key = d.date_key group by d.year_month""",
    ),
)
def distinct_orders(spark: SparkSession, root: str) -> DataFrame:
    """A4 + D14: exact distinct orders per month beside the line count."""
    star = build_star(spark, root)
    return (
        star.fact.join(star.date_dim("date_key", "year_month"), "date_key")
        .groupBy("year_month")
        .agg(F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("order_lines"))
    )


# --- D17 accumulating snapshot -----------------------------------------------------------------
SHIP_CUTOFF = dt.date(1998, 1, 1)  # first batch: shipments before this date


@register(
    "accumulating_snapshot",
    """select o_orderkey as order_id,
  cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as int) as order_date_key,
  cast(year(min(l_shipdate)) * 10000 + month(min(l_shipdate)) * 100 + day(min(l_shipdate)) as int) as first_ship_date_key,
  cast(year(max(l_shipdate)) * 10000 + month(max(l_shipdate)) * 100 + day(max(l_shipdate)) as int) as last_ship_date_key,
  cast(date_diff('day', cast(o_orderdate as date), cast(min(l_shipdate) as date)) as int) as days_to_first_ship,
  cast(date_diff('day', cast(o_orderdate as date), cast(max(l_shipdate) as date)) as int) as days_to_last_ship,
  count(*) as shipped_lines
from lineitem join orders on l_orderkey = o_orderkey group by o_orderkey, o_orderdate""",
)
def accumulating_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Milestones of each order from two stored shipment batches."""
    ships, store = src.shipments(Tables(spark, root)), scratch_path(spark, "accumulating")
    early = F.col("ship_date") < F.lit(SHIP_CUTOFF)
    for name, batch in (("early", ships.where(early)), ("rest", ships.where(~early))):
        snapshots.fold_batch(batch, store, name)
    return facts.with_milestone_keys(snapshots.accumulating_fact(spark, store))


# --- D15 / D16 balances -------------------------------------------------------------------------
_PERIODIC_SQL = """, daily as (
  select user_id, cast(ts as date) as day, sum(cast(value as decimal(18,2))) as day_amount, count(*) as day_events
  from events group by user_id, cast(ts as date)
), runs as (
  select *,
    cast(sum(day_amount) over (partition by user_id order by day rows between unbounded preceding and current row)
      as decimal(38,2)) as balance,
    coalesce(lead(day) over (partition by user_id order by day) - 1, (select max(cast(ts as date)) from events)) as until
  from daily
), periodic as (
  select user_id, cast(g as date) as snapshot_date,
    cast(year(g) * 10000 + month(g) * 100 + day(g) as int) as date_key,
    balance,
    case when cast(g as date) = day then day_amount else cast(0 as decimal(38,2)) end as day_amount,
    cast(case when cast(g as date) = day then day_events else 0 end as bigint) as day_events
  from runs, unnest(generate_series(cast(day as timestamp), cast(until as timestamp), interval 1 day)) as t(g)
)"""


def _periodic(spark: SparkSession, root: str) -> DataFrame:
    ev = Tables(spark, root).events
    end = ev.agg(F.max(F.col("ts").cast("date")).alias("d")).first()["d"]
    return facts.periodic_snapshot(ev, "user_id", "ts", "value", end)


@register(
    "periodic_snapshot",
    "with " + _PERIODIC_SQL.lstrip(", ") + "\nselect * from periodic",
)
def periodic_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """One row per user per day with the carried balance."""
    return _periodic(spark, root)


@register(
    "semi_additive",
    "with "
    + _PERIODIC_SQL.lstrip(", ")
    + """, totals as (
  select snapshot_date, cast(sum(balance) as decimal(38,2)) as total_balance, count(*) as entities
  from periodic group by snapshot_date
)
select strftime(snapshot_date, '%Y-%m') as year_month, max(snapshot_date) as period_end,
  arg_max(total_balance, snapshot_date) as closing_balance, arg_max(entities, snapshot_date) as entities
from totals group by strftime(snapshot_date, '%Y-%m')""",
)
def semi_additive(spark: SparkSession, root: str) -> DataFrame:
    """Balances add across users on a day, but a month takes its last day."""
    snap = _periodic(spark, root)
    return measures.period_end_balance(snap, "snapshot_date", year_month("snapshot_date"), "year_month")


# --- D22 / D23 decoding and bands ------------------------------------------------------------------
# Order status codes and their labels; price band edges.
ORDER_STATUS = {"F": "Fulfilled", "O": "Open", "P": "Partially shipped"}
PRICE_EDGES = (925, 975)
PRICE_BANDS = ("budget", "standard", "premium")


@register(
    "status_decode",
    """select o_orderstatus as order_status,
  case o_orderstatus when 'F' then 'Fulfilled' when 'O' then 'Open' when 'P' then 'Partially shipped'
    else 'Unknown' end as order_status_label,
  count(*) as orders
from orders group by o_orderstatus""",
)
def status_decode(spark: SparkSession, root: str) -> DataFrame:
    """Code -> label, unknown codes labelled 'Unknown'."""
    o = Tables(spark, root).orders
    return o.groupBy(F.col("o_orderstatus").alias("order_status")).agg(F.count(F.lit(1)).alias("orders")).select(
        "order_status", measures.decode("order_status", ORDER_STATUS).alias("order_status_label"), "orders"
    )


@register(
    "price_band",
    with_ctes(
        ["f_dim_product"],
        """select product_key, product_id, unit_price,
  case when unit_price < 925 then 'budget' when unit_price < 975 then 'standard' else 'premium' end as price_band
from f_dim_product""",
    ),
)
def price_band(spark: SparkSession, root: str) -> DataFrame:
    """A precomputed band on the product dimension."""
    star = build_star(spark, root)
    return star.dim_product.select(
        "product_key", "product_id", "unit_price", measures.band("unit_price", PRICE_EDGES, PRICE_BANDS).alias("price_band")
    )


# --- D20 / D21 snowflake and outrigger ---------------------------------------------------------------
PRODUCT_COLUMNS = ["product_key", "product_id", "product_name", "category", "subcategory", "brand", "unit_price"]


@register(
    "snowflake_branch",
    with_ctes(
        ["f_dim_product"],
        """select cast(row_number() over (order by category) as bigint) as category_key, category
from (select distinct category from f_dim_product)""",
    ),
)
def snowflake_branch(spark: SparkSession, root: str) -> DataFrame:
    """The category branch moved to its own keyed table."""
    sub, _ = conform.snowflake(build_star(spark, root).dim_product, ["category"], "category_key")
    return sub


@register("snowflake_roundtrip", with_ctes(["f_dim_product"], "select * from f_dim_product"))
def snowflake_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Snowflaked product flattened back equals the star's product."""
    sub, slim = conform.snowflake(build_star(spark, root).dim_product, ["category"], "category_key")
    return conform.flatten(slim, sub, "category_key", PRODUCT_COLUMNS)


@register(
    "outrigger",
    with_ctes(
        ["f_dim_customer", "dim_date"],
        """select c.customer_key, c.customer_id, c.valid_from,
  d.year as valid_from_year, d.quarter as valid_from_quarter, d.month_name as valid_from_month_name
from f_dim_customer c left join dim_date d on d.full_date = c.valid_from""",
    ),
)
def outrigger(spark: SparkSession, root: str) -> DataFrame:
    """The customer's version start described by the shared calendar."""
    star = build_star(spark, root)
    dim = star.dim_customer.select("customer_key", "customer_id", "valid_from")
    # the calendar is tiny and bounded; many versions share one valid_from date
    cal = star.date_dim("full_date", "year", "quarter", "month_name")
    return conform.outrigger(dim, "valid_from", cal, ["year", "quarter", "month_name"], "valid_from_")


# --- D6 / D24 partitioned fact and bounded reload --------------------------------------------------------
RELOAD_FIRST = dt.date(1998, 7, 1)
RELOAD_LAST = dt.date(1998, 7, 31)


@register(
    "window_reload",
    with_ctes(["f_fact"], "select *, cast(date_key // 100 as int) as month_key from f_fact"),
)
def window_reload(spark: SparkSession, root: str) -> DataFrame:
    """A half-written business window is deleted and re-inserted.

    The first write loses part of July 1998 (as a failed load would); the
    reload replaces only that month's partition and is safe to repeat.
    """
    star = build_star(spark, root, with_sale_key=True)
    fact = star.fact
    path = scratch_path(spark, "fact_sales")
    lo, hi = RELOAD_FIRST.year * 100 + RELOAD_FIRST.month, RELOAD_LAST.year * 100 + RELOAD_LAST.month
    month = (F.col("date_key") / 100).cast("int")
    damaged = fact.where(~month.between(lo, hi) | (F.col("quantity") < 25))
    write_fact(damaged, path)
    batch = fact.where(month.between(lo, hi))
    reload_window(batch, path, RELOAD_FIRST, RELOAD_LAST)
    reload_window(batch, path, RELOAD_FIRST, RELOAD_LAST)  # a repeat changes nothing
    return read_fact(spark, path).select(*FACT_SALES_COLUMNS, "month_key")


@register(
    "window_reload_empty",
    with_ctes(
        ["f_fact"],
        f"""select *, cast(date_key // 100 as int) as month_key from f_fact
where date_key not between {RELOAD_FIRST:%Y%m%d} and {RELOAD_LAST:%Y%m%d}""",
    ),
)
def window_reload_empty(spark: SparkSession, root: str) -> DataFrame:
    """A reload without rows empties its window."""
    fact = build_star(spark, root, with_sale_key=True).fact
    path = scratch_path(spark, "fact_sales")
    write_fact(fact, path)
    reload_window(fact.where(F.lit(False)), path, RELOAD_FIRST, RELOAD_LAST)
    return read_fact(spark, path).select(*FACT_SALES_COLUMNS, "month_key")


@register(
    "rebuild_drops_month",
    with_ctes(
        ["f_fact"],
        f"""select *, cast(date_key // 100 as int) as month_key from f_fact
where date_key not between {RELOAD_FIRST:%Y%m%d} and {RELOAD_LAST:%Y%m%d}""",
    ),
)
def rebuild_drops_month(spark: SparkSession, root: str) -> DataFrame:
    """A rebuilt fact keeps no month of the load before it."""
    fact = fact_by_month(build_star(spark, root, with_sale_key=True).fact)
    path = scratch_path(spark, "fact_sales")
    write_fact(fact, path, whole=True, clustered=True)
    lo, hi = (int(d.strftime("%Y%m%d")) for d in (RELOAD_FIRST, RELOAD_LAST))
    write_fact(fact.where(~F.col("date_key").between(lo, hi)), path, whole=True, clustered=True)
    return read_fact(spark, path).select(*FACT_SALES_COLUMNS, "month_key")


@register(
    "fact_month_slice",
    with_ctes(
        ["f_fact"],
        """select cast(date_key // 100 as int) as month_key, count(*) as order_lines,
  cast(sum(net_amount) as decimal(38,2)) as net_amount
from f_fact where date_key // 100 between 200001 and 200006 group by date_key // 100""",
    ),
)
def fact_month_slice(spark: SparkSession, root: str) -> DataFrame:
    """The fact written by month; a month filter prunes partitions
    without any dimension join."""
    star = build_star(spark, root)
    path = scratch_path(spark, "fact_sales")
    write_fact(star.fact, path)
    f = read_fact(spark, path).where(F.col("month_key").between(200001, 200006))
    return f.groupBy("month_key").agg(F.count(F.lit(1)).alias("order_lines"), exact_sum("net_amount").alias("net_amount"))


# --- D1 restatement on a versioned dimension ----------------------------------------------------------------
@register(
    "scd1_restate",
    with_ctes(
        ["f_dim_customer", "f_snapshots"],
        """, latest as (
  select customer_id, arg_max(email, as_of) as latest_email from f_snapshots group by customer_id
)
select d.customer_key, d.customer_id, d.first_name, d.last_name, latest.latest_email as email,
  d.segment, d.city, d.region, d.valid_from, d.valid_to, d.is_current, d.version
from f_dim_customer d join latest on latest.customer_id = d.customer_id""",
    ),
)
def scd1_restate(spark: SparkSession, root: str) -> DataFrame:
    """D1 on the Type-2 dimension: a Type-1 correction of e-mail restates
    every version (scope "all")."""
    snaps = src.customer_snapshots(Tables(spark, root))
    dim = rebuild_history(snaps, CUSTOMER_SPEC)
    latest = snaps.groupBy("customer_id").agg(F.max_by("email", "as_of").alias("email"))
    from starloom.operators.scd import restate_type1

    return restate_type1(dim, latest, CUSTOMER_SPEC, ("email",))


@register(
    "decode_band",
    with_ctes(
        ["f_stg_sales", "f_dim_product"],
        """select case o.o_orderstatus when 'F' then 'Fulfilled' when 'O' then 'Open' when 'P' then 'Partially shipped'
    else 'Unknown' end as order_status_label,
  case when p.unit_price < 925 then 'budget' when p.unit_price < 975 then 'standard' else 'premium' end as price_band,
  count(*) as order_lines, cast(sum(s.net_amount) as decimal(38,2)) as net_amount
from f_stg_sales s join orders o on o.o_orderkey = s.order_id
join f_dim_product p on p.product_id = s.product_id
group by 1, 2""",
    ),
)
def decode_band(spark: SparkSession, root: str) -> DataFrame:
    """D22 + D23 together: revenue by decoded order status and price band.

    The code table is an in-expression map and the band a CASE chain, both
    evaluated inside whole-stage codegen; the product side is size-checked.
    """
    star = build_star(spark, root)
    status = star.tables.orders.select(
        F.col("o_orderkey").alias("order_id"),
        measures.decode("o_orderstatus", ORDER_STATUS).alias("order_status_label"),
    )
    bands = star.dim("product", "product_id", measures.band("unit_price", PRICE_EDGES, PRICE_BANDS).alias("price_band"))
    lines = star.stg_sales.select("order_id", "product_id", "net_amount").join(status, "order_id").join(bands, "product_id")
    return lines.groupBy("order_status_label", "price_band").agg(
        F.count(F.lit(1)).alias("order_lines"), exact_sum("net_amount").alias("net_amount")
    )
