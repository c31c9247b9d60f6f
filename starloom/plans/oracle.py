"""Independent SQL (DuckDB dialect) for every registered query.

The star is rebuilt in plain SQL from the same input tables with window
functions (``lag``/``lead``/``row_number``), a different route from the
Spark operators (dense-key assignment, merge, as-of lookup). Each query
string is one statement: needed CTEs are prepended in dependency order.
"""

from __future__ import annotations

_SNAPSHOT_ROWS = """
  select s.as_of, s.n, customer.*,
    (s.n = 2 and c_custkey % 10 in (0, 3)) or (s.n = 3 and c_custkey % 10 = 3) as seg_moves,
    (s.n >= 2 and c_custkey % 10 in (3, 6)) as geo_moves
  from customer cross join f_sched s"""

_SNAPSHOTS = """
select c.as_of, c_custkey as customer_id,
  'Customer' as first_name,
  substr(c_name, 10) as last_name,
  lower(replace(c_name, '#', '.')) || case when n = 3 and c_custkey % 10 in (0, 5) then '.new' else '' end
    || '@example.test' as email,
  case when not seg_moves then c_mktsegment
       when c_mktsegment = 'AUTOMOBILE' then 'BUILDING'
       when c_mktsegment = 'BUILDING' then 'FURNITURE'
       when c_mktsegment = 'FURNITURE' then 'HOUSEHOLD'
       when c_mktsegment = 'HOUSEHOLD' then 'MACHINERY'
       else 'AUTOMOBILE' end as segment,
  g.n_name as city, g.r_name as region
from f_snap_rows c join f_geo g
  on g.n_nationkey = case when geo_moves then (c_nationkey + 1) % 25 else c_nationkey end"""


def _dim_customer(source: str) -> str:
    return f"""
with l as (
  select *,
    lag(as_of) over (partition by customer_id order by as_of) as p_as_of,
    lag(segment) over (partition by customer_id order by as_of) as p_segment,
    lag(city) over (partition by customer_id order by as_of) as p_city,
    lag(region) over (partition by customer_id order by as_of) as p_region
  from {source}
), v as (
  select * from l
  where p_as_of is null or segment is distinct from p_segment
     or city is distinct from p_city or region is distinct from p_region
)
select cast(row_number() over (order by as_of, customer_id) as bigint) as customer_key,
  customer_id, first_name, last_name, email, segment, city, region,
  cast(as_of as date) as valid_from,
  cast(coalesce(lead(as_of) over (partition by customer_id order by as_of), date '9999-12-31') as date) as valid_to,
  lead(as_of) over (partition by customer_id order by as_of) is null as is_current,
  cast(row_number() over (partition by customer_id order by as_of) as int) as version
from v"""


def _fact(dim: str, unknown: bool = False) -> str:
    """Order lines beside the member version that began last by the order date."""
    kind, member = ("left", f"coalesce({dim}.customer_key, -1)") if unknown else ("", f"{dim}.customer_key")
    return f"""
select cast(row_number() over (order by order_id, line_number, product_id, store_id,
    quantity, discount_pct, gross_amount, net_amount) as bigint) as sale_key, order_id,
  cast(strftime(order_date, '%Y%m%d') as int) as date_key, product_key, store_key,
  cast({member} as bigint) as customer_key, quantity, f_stg_sales.unit_price, discount_pct, gross_amount, net_amount
from f_stg_sales
asof {kind} join {dim} on f_stg_sales.customer_id = {dim}.customer_id and order_date >= valid_from
join f_dim_product using (product_id) join f_dim_store using (store_id)"""


CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "f_geo": (
        "select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey",
        (),
    ),
    "f_sched": (
        "select date '1995-01-01' as as_of, 1 as n union all select date '1998-07-01', 2 "
        "union all select date '2000-01-01', 3",
        (),
    ),
    "f_snap_rows": (_SNAPSHOT_ROWS, ("f_sched",)),
    "f_snapshots": (_SNAPSHOTS, ("f_geo", "f_snap_rows")),
    "f_snapshots_late": (
        "select * from f_snapshots where not (as_of = date '1995-01-01' and customer_id % 20 = 19)",
        ("f_snapshots",),
    ),
    "f_dim_customer": (_dim_customer("f_snapshots"), ("f_snapshots",)),
    "f_dim_customer_late": (_dim_customer("f_snapshots_late"), ("f_snapshots_late",)),
    "f_dim_product": (
        """select p_partkey + 1 as product_key, p_partkey as product_id, p_name as product_name,
  p_type as category, split_part(p_name, ' ', 2) as subcategory, p_brand as brand,
  cast(p_retailprice as decimal(10,2)) as unit_price
from part""",
        (),
    ),
    "f_dim_store": (
        """select s_suppkey + 1 as store_key, s_suppkey as store_id, s_name as store_name,
  n_name as city, r_name as region, n_name as country
from supplier join f_geo on s_nationkey = n_nationkey""",
        ("f_geo",),
    ),
    "f_stg_sales": (
        """select l_orderkey as order_id, l_linenumber as line_number, cast(o_orderdate as date) as order_date,
  l_partkey as product_id, l_suppkey as store_id, o_custkey as customer_id,
  cast(l_quantity as int) as quantity,
  cast(p_retailprice as decimal(10,2)) as unit_price,
  cast(l_discount as decimal(5,4)) as discount_pct,
  cast(l_extendedprice as decimal(12,2)) as gross_amount,
  cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(5,4))) as decimal(12,2))
    as net_amount
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
        (),
    ),
    "f_fact": (_fact("f_dim_customer"), ("f_stg_sales", "f_dim_product", "f_dim_store", "f_dim_customer")),
    "f_fact_unknown": (
        _fact("f_dim_customer_late", unknown=True),
        ("f_stg_sales", "f_dim_product", "f_dim_store", "f_dim_customer_late"),
    ),
    "f_segment_flow": (
        """
select then_segment, now_segment, sum(net_amount) as net
from f_fact join (
  select customer_key, segment as then_segment,
    arg_max(segment, version) over (partition by customer_id) as now_segment
  from f_dim_customer
) using (customer_key)
group by all""",
        ("f_fact", "f_dim_customer"),
    ),
    "f_bounds": (
        "select make_date(cast(year(min(o_orderdate)) as int), 1, 1) as lo, "
        "make_date(cast(year(max(o_orderdate)) as int), 12, 31) as hi from orders",
        (),
    ),
    "dim_date": (
        """select cast(strftime(day, '%Y%m%d') as int) as date_key, day as full_date,
  cast(strftime(day, '%d') as smallint) as day_of_month, strftime(day, '%A') as day_name,
  cast(strftime(day, '%u') as smallint) as day_of_week, strftime(day, '%u') in ('6', '7') as is_weekend,
  cast(strftime(day, '%m') as smallint) as month_number, strftime(day, '%B') as month_name,
  cast((month(day) + 2) // 3 as smallint) as quarter, cast(strftime(day, '%Y') as smallint) as year,
  substr(cast(day as varchar), 1, 7) as year_month
from (select lo + cast(i as int) as day from (select lo, unnest(range(hi - lo + 1)) as i from f_bounds))""",
        ("f_bounds",),
    ),
}


def with_ctes(names: list[str] | tuple[str, ...], body: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and theirs), dependencies first."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in CTES[n][1]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} as ({CTES[n][0]}\n)" for n in ordered]
    return "with " + ",\n".join(parts) + "\n" + body.strip()
