"""Registered load-side queries: SCD statistics and re-run, loader variants
(Type 1, Type 3, hybrid, product Type 2, unknown member, late repair,
staging replay, CSV staging) and the warehouse checks T1-T10."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starloom.functions.money import whole
from starloom.operators import checks as C
from starloom.operators.facts import latest_per_merge_key
from starloom.operators.scd import (
    load_statistics,
    merge_snapshot,
    rebuild_history,
    replay_snapshots,
    type1_rebuild,
    type3_rebuild,
)
from starloom.plans import analytics as A
from starloom.plans.oracle import with_ctes
from starloom.plans.registry import DIM_CUSTOMER_COLS, Q1_MONTHS, Q1_TOTAL, register
from starloom.plans.star import build_star
from starloom.schemas import CUSTOMER_SPEC, DIM_DATE, FACT_SALES_COLUMNS, PRODUCT_SPEC, STG_GRAIN, STG_SALES, UNKNOWN_KEY
from starloom.session import cut_lineage, scratch_path
from starloom.sources import csv_stage
from starloom.sources import star_inputs as src
from starloom.sources.tables import Tables

_TRACKED_CHANGED = (
    "p_as_of is not null and (segment is distinct from p_segment "
    "or city is distinct from p_city or region is distinct from p_region)"
)
_LAGGED = """, l as (
  select *, lag(as_of) over w as p_as_of, lag(segment) over w as p_segment,
    lag(city) over w as p_city, lag(region) over w as p_region
  from f_snapshots window w as (partition by customer_id order by as_of)
)"""


def _dec(expr: str) -> str:
    return f"cast({expr} as decimal(38,2))"


def _metric_union(pairs: list[tuple[str, str]]) -> str:
    return "\nunion all ".join(f"select '{m}' as metric, {_dec(e)} as value" for m, e in pairs)


# --- SCD statistics and re-run ----------------------------------------------------
@register(
    "scd2_load_stats",
    with_ctes(
        ["f_snapshots"],
        _LAGGED
        + f"""
select as_of,
  cast(count(*) filter (where p_as_of is null) as bigint) as inserted,
  cast(count(*) filter (where {_TRACKED_CHANGED}) as bigint) as versioned,
  cast(count(*) filter (where p_as_of is not null and not ({_TRACKED_CHANGED})) as bigint) as unchanged
from l group by as_of""",
    ),
)
def scd2_load_stats(spark: SparkSession, root: str) -> DataFrame:
    return load_statistics(src.customer_snapshots(Tables(spark, root)), CUSTOMER_SPEC)


@register(
    "scd2_rerun",
    with_ctes(
        ["f_dim_customer", "f_snapshots"],
        """select cast((select count(*) from f_dim_customer) as bigint) as rows_before,
  cast((select count(*) from f_dim_customer) as bigint) as rows_after,
  cast(0 as bigint) as inserted, cast(0 as bigint) as versioned,
  cast((select count(*) from f_snapshots where as_of = date '2000-01-01') as bigint) as unchanged""",
    ),
)
def scd2_rerun(spark: SparkSession, root: str) -> DataFrame:
    """K9: replay every snapshot, then apply the latest one again."""
    snaps = src.customer_snapshots(Tables(spark, root))
    dim = replay_snapshots(snaps, CUSTOMER_SPEC, dates=list(src.SNAPSHOT_DATES)).dimension
    last = src.SNAPSHOT_DATES[-1]
    again = merge_snapshot(dim, snaps.where(F.col("as_of") == F.lit(last)), last, CUSTOMER_SPEC)
    before = dim.count()
    after = again.dimension.count()
    row = Row(rows_before=before, rows_after=after, **again.counts)
    return spark.createDataFrame(
        [row], "rows_before bigint, rows_after bigint, inserted bigint, versioned bigint, unchanged bigint"
    )


# --- loader variants -------------------------------------------------------------
_ATTRS = "first_name, last_name, email, segment, city, region"


@register(
    "scd1",
    with_ctes(
        ["f_snapshots"],
        f""", m as (
  select customer_id, min(as_of) as first_seen, max(as_of) as last_seen from f_snapshots group by customer_id
)
select cast(row_number() over (order by m.first_seen, m.customer_id) as bigint) as customer_key,
  s.customer_id, {', '.join('s.' + a for a in _ATTRS.split(', '))}
from m join f_snapshots s on s.customer_id = m.customer_id and s.as_of = m.last_seen""",
    ),
)
def scd1(spark: SparkSession, root: str) -> DataFrame:
    snaps = src.customer_snapshots(Tables(spark, root))
    return type1_rebuild(snaps, "customer_id", CUSTOMER_SPEC.attributes, "customer_key")


@register(
    "scd3",
    with_ctes(
        ["f_snapshots"],
        """, l as (
  select customer_id, as_of, segment,
    lag(segment) over w as prev, lag(as_of) over w as p_as_of
  from f_snapshots window w as (partition by customer_id order by as_of)
), m as (
  select customer_id, min(as_of) as first_seen,
    arg_max(segment, as_of) as current_segment,
    arg_max(prev, as_of) filter (where p_as_of is not null and segment is distinct from prev) as previous_segment,
    max(as_of) filter (where p_as_of is not null and segment is distinct from prev) as segment_changed_on
  from l group by customer_id
)
select cast(row_number() over (order by first_seen, customer_id) as bigint) as customer_key,
  customer_id, current_segment, previous_segment, cast(segment_changed_on as date) as segment_changed_on
from m""",
    ),
)
def scd3(spark: SparkSession, root: str) -> DataFrame:
    snaps = src.customer_snapshots(Tables(spark, root))
    return type3_rebuild(snaps, "customer_id", "segment", "customer_key")


HYBRID_ALL = dataclasses.replace(CUSTOMER_SPEC, type1=("email",), type1_scope="all")
HYBRID_CURRENT = dataclasses.replace(CUSTOMER_SPEC, type1=("email",), type1_scope="current")


@register(
    "scd_hybrid",
    with_ctes(
        ["f_dim_customer", "f_snapshots"],
        f""", latest as (
  select customer_id, arg_max(email, as_of) as latest_email from f_snapshots group by customer_id
)
select d.customer_key, d.customer_id, d.first_name, d.last_name, latest.latest_email as email,
  d.segment, d.city, d.region, d.valid_from, d.valid_to, d.is_current, d.version
from f_dim_customer d join latest on latest.customer_id = d.customer_id""",
    ),
)
def scd_hybrid(spark: SparkSession, root: str) -> DataFrame:
    return rebuild_history(src.customer_snapshots(Tables(spark, root)), HYBRID_ALL)


@register(
    "scd_hybrid_current",
    with_ctes(
        ["f_dim_customer", "f_snapshots"],
        """, seen as (
  select d.customer_key, arg_max(s.email, s.as_of) as last_email
  from f_dim_customer d join f_snapshots s
    on s.customer_id = d.customer_id and s.as_of >= d.valid_from and s.as_of < d.valid_to
  group by d.customer_key
)
select d.customer_key, d.customer_id, d.first_name, d.last_name,
  seen.last_email as email,
  d.segment, d.city, d.region, d.valid_from, d.valid_to, d.is_current, d.version
from f_dim_customer d join seen on seen.customer_key = d.customer_key""",
    ),
)
def scd_hybrid_current(spark: SparkSession, root: str) -> DataFrame:
    return rebuild_history(src.customer_snapshots(Tables(spark, root)), HYBRID_CURRENT)


_PRODUCT_SNAPSHOTS = """, ps as (
  select sd.as_of, p.product_id, p.product_name,
    case when sd.as_of = date '1999-01-01' and p.product_id % 10 = 4 then p.category || ' II' else p.category end
      as category,
    p.subcategory, p.brand, p.unit_price
  from f_dim_product p cross join (select date '1995-01-01' as as_of union all select date '1999-01-01') sd
), pl as (
  select *, lag(as_of) over w as p_as_of, lag(category) over w as p_category, lag(brand) over w as p_brand
  from ps window w as (partition by product_id order by as_of)
), pv as (
  select * from pl where p_as_of is null or category is distinct from p_category or brand is distinct from p_brand
)"""


@register(
    "product_scd2",
    with_ctes(
        ["f_dim_product"],
        _PRODUCT_SNAPSHOTS
        + """
select cast(row_number() over (order by as_of, product_id) as bigint) as product_key,
  product_id, product_name, category, subcategory, brand, unit_price,
  cast(as_of as date) as valid_from,
  cast(coalesce(lead(as_of) over (partition by product_id order by as_of), date '9999-12-31') as date) as valid_to,
  lead(as_of) over (partition by product_id order by as_of) is null as is_current,
  cast(row_number() over (partition by product_id order by as_of) as int) as version
from pv""",
    ),
)
def product_scd2(spark: SparkSession, root: str) -> DataFrame:
    """Type 2 on another dimension (reclassified products)."""
    return rebuild_history(src.product_snapshots(Tables(spark, root)), PRODUCT_SPEC)


@register("unknown_member", with_ctes(["f_fact_unknown"], "select * from f_fact_unknown"))
def unknown_member(spark: SparkSession, root: str) -> DataFrame:
    """Facts of members not yet known map to key -1 instead of vanishing."""
    return build_star(spark, root, late=True, mode="unknown", with_sale_key=True).fact


@register(
    "late_repair",
    with_ctes(
        ["f_stg_sales", "f_dim_customer_late"],
        """select s.order_id, s.line_number, s.product_id, s.store_id, s.customer_id, s.order_date,
  cast(coalesce(c.customer_key, f1.customer_key, -1) as bigint) as customer_key
from f_stg_sales s
left join f_dim_customer_late c on c.customer_id = s.customer_id
  and s.order_date >= c.valid_from and s.order_date < c.valid_to
left join f_dim_customer_late f1 on f1.customer_id = s.customer_id and f1.version = 1
  and s.order_date < f1.valid_from""",
    ),
)
def late_repair(spark: SparkSession, root: str) -> DataFrame:
    """Lines are loaded as their customers become known. Each snapshot is merged
    before the lines dated up to the next one are loaded; lines of members that
    it doesn't list are stored on -1 and parked, and repaired in the stored fact
    after the merge that brings the member."""
    from starloom.plans.warehouse import load_increment, merge_into, read_fact, repair_parked, write_static_dimensions

    t, out = Tables(spark, root), scratch_path(spark, "late-warehouse")
    write_static_dimensions(spark, t, out)
    stg, snaps = cut_lineage(src.staged_sales(t), "staged"), src.customer_snapshots(t, late=True)
    natural = ("line_number", "product_id", "store_id", "customer_id", "order_date")
    span = stg.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    starts = [min(span["lo"], src.SNAPSHOT_DATES[0]), *src.SNAPSHOT_DATES[1:], span["hi"] + dt.timedelta(days=1)]
    for n, day in enumerate(src.SNAPSHOT_DATES):
        snap = snaps.where(F.col("as_of") == F.lit(day))
        merge_into(spark, f"{out}/dim_customer", snap, day, CUSTOMER_SPEC, seed=True)
        repair_parked(spark, out)
        first, last = starts[n], starts[n + 1] - dt.timedelta(days=1)
        lines = stg.where(F.col("order_date").between(F.lit(first), F.lit(last)))
        load_increment(spark, out, lines, first, last, columns=(*FACT_SALES_COLUMNS, *natural))
    repair_parked(spark, out)
    return read_fact(spark, f"{out}/fact_sales").select("order_id", *natural, "customer_key")


# Replay window: the extract of orders from this date on is delivered again,
# corrected (discount removed), and must replace the first delivery in place.
REPLAY_FROM = dt.date(2001, 1, 1)
_MERGE_KEY = ("order_id", "line_number", "product_id", "store_id", "order_date")
_STG_COLS = [f.name for f in STG_SALES.fields]


@register(
    "staging_replay",
    with_ctes(
        ["f_stg_sales"],
        f""", batches as (
  select 1 as batch_no, * from f_stg_sales
  union all
  select 2, order_id, line_number, order_date, product_id, store_id, customer_id, quantity, unit_price,
    cast(0 as decimal(5,4)), gross_amount, gross_amount
  from f_stg_sales where order_date >= date '{REPLAY_FROM}'
)
select {', '.join(_STG_COLS)} from batches
qualify batch_no = max(batch_no) over (partition by {', '.join(_MERGE_KEY)})""",
    ),
)
def staging_replay(spark: SparkSession, root: str) -> DataFrame:
    """Truncate-and-reload staging where a replayed row updates in place."""
    stg = src.staged_sales(Tables(spark, root))
    first = stg.withColumn("batch_no", F.lit(1))
    again = (
        stg.where(F.col("order_date") >= F.lit(REPLAY_FROM))
        .withColumn("discount_pct", F.lit(0).cast("decimal(5,4)"))
        .withColumn("net_amount", F.col("gross_amount"))
        .withColumn("batch_no", F.lit(2))
    )
    merged = latest_per_merge_key(first.unionByName(again), _MERGE_KEY, "batch_no")
    return merged.select(*_STG_COLS)


@register("csv_staging", with_ctes(["f_stg_sales"], "select * from f_stg_sales"))
def csv_staging(spark: SparkSession, root: str) -> DataFrame:
    """Land the extract as header CSV, bulk-load it with the fixed schema."""
    path = scratch_path(spark, "stg_sales_csv")
    csv_stage.write_extract(src.staged_sales(Tables(spark, root)), path)
    loaded = csv_stage.read_extract(spark, path, STG_SALES)
    missing = csv_stage.missing_required(loaded, STG_SALES)
    if missing:
        raise ValueError(f"{missing} staged rows miss a required value")
    return loaded


# --- checks T1-T10 ----------------------------------------------------------------
@register(
    "check_grain",
    with_ctes(
        ["f_fact", "f_stg_sales"],
        _metric_union(
            [
                ("staged_lines", "(select count(*) from f_stg_sales)"),
                ("fact_lines", "(select count(*) from f_fact)"),
                (
                    "duplicate_grain_keys",
                    "(select count(*) from (select 1 from f_stg_sales group by order_id, line_number, "
                    "product_id, store_id having count(*) > 1))",
                ),
                (
                    "duplicate_fact_keys",
                    "(select count(*) from (select 1 from f_fact group by sale_key having count(*) > 1))",
                ),
            ]
        ),
    ),
)
def check_grain(spark: SparkSession, root: str) -> DataFrame:
    star = build_star(spark, root, with_sale_key=True)
    return C.grain(star.stg_sales, star.fact, STG_GRAIN, "sale_key")


@register(
    "check_orphans",
    with_ctes(
        ["f_fact", "dim_date", "f_dim_product", "f_dim_store", "f_dim_customer"],
        _metric_union(
            [
                (f"orphan_{k}", f"(select count(*) from f_fact f where not exists "
                 f"(select 1 from {d} x where x.{k} = f.{k}))")
                for k, d in [
                    ("date_key", "dim_date"),
                    ("product_key", "f_dim_product"),
                    ("store_key", "f_dim_store"),
                    ("customer_key", "f_dim_customer"),
                ]
            ]
        ),
    ),
)
def check_orphans(spark: SparkSession, root: str) -> DataFrame:
    star = build_star(spark, root)
    return C.orphans(
        star.fact,
        {
            "date_key": star.date_dim("date_key"),
            "product_key": star.dim("product", "product_key"),
            "store_key": star.dim("store", "store_key"),
            "customer_key": star.dim("customer", "customer_key"),
        },
    )


@register(
    "check_dimension",
    with_ctes(
        ["f_dim_customer"],
        """, t as (
  select *, lead(valid_from) over w as nxt, row_number() over w as rn
  from f_dim_customer window w as (partition by customer_id order by version)
)
"""
        + _metric_union(
            [
                (
                    "members_not_one_current",
                    "(select count(*) from (select customer_id from f_dim_customer group by customer_id "
                    "having count(*) filter (where is_current) <> 1))",
                ),
                ("gap", "(select count(*) from t where nxt is not null and valid_to <> nxt)"),
                ("last_not_open", "(select count(*) from t where nxt is null and valid_to <> date '9999-12-31')"),
                ("wrong_current", "(select count(*) from t where is_current <> (nxt is null))"),
                ("empty_window", "(select count(*) from t where valid_from >= valid_to)"),
                ("version_hole", "(select count(*) from t where version <> rn)"),
                (
                    "members_with_history",
                    "(select count(*) from (select customer_id from f_dim_customer group by customer_id "
                    "having count(*) > 1))",
                ),
            ]
        ),
    ),
)
def check_dimension(spark: SparkSession, root: str) -> DataFrame:
    """T3 + T4 + T10 on the Type-2 customer dimension."""
    dim = rebuild_history(src.customer_snapshots(Tables(spark, root)), CUSTOMER_SPEC)
    return C.metrics(
        [C.one_current(dim, CUSTOMER_SPEC), C.tiling(dim, CUSTOMER_SPEC), C.multi_version(dim, CUSTOMER_SPEC)]
    )


@register(
    "check_totals",
    with_ctes(
        ["f_fact", "f_segment_flow"],
        _metric_union(
            [
                ("grand_total", "(select sum(net_amount) from f_fact)"),
                ("point_in_time_total", "(select sum(net) from f_segment_flow where then_segment is not null)"),
                ("restated_total", "(select sum(net) from f_segment_flow where now_segment is not null)"),
                (
                    "segments_with_delta",
                    "(select count(*) from (select seg from f_segment_flow unpivot (seg for side in "
                    "(then_segment as 'then', now_segment as 'now')) group by seg having round("
                    "sum(case when side = 'now' then net else -net end), 0) <> 0))",
                ),
            ]
        ),
    ),
)
def check_totals(spark: SparkSession, root: str) -> DataFrame:
    """Both attributions equal the grand total; the split differs. The total comes
    from the same scan, but from rows that meet no dimension."""
    star = build_star(spark, root)
    lines = C.with_total(star.fact, ["customer_key"], ["net_amount"])
    by = (C.TOTAL,)
    # one row per segment, and one for the grand total
    sides = A.segment_sides(A.segment_attribution(star, lines, by), by)
    total, known = F.col(C.TOTAL), F.col("segment").isNotNull()
    delta = whole(F.coalesce("res", F.lit(0)) - F.coalesce("pit", F.lit(0)))
    both = F.col("pit").isNotNull() & F.col("res").isNotNull()
    return C.measured(
        sides,
        grand_total=F.sum(F.when(total, F.col("pit"))),
        point_in_time_total=F.sum(F.when(~total & known, F.col("pit"))),
        restated_total=F.sum(F.when(~total, F.col("res"))),
        segments_with_delta=F.count_if(~total & known & both & (delta != 0)),
    )


@register(
    "check_trend",
    with_ctes(
        ["f_fact", "dim_date"],
        _metric_union(
            [
                (
                    "trend_order_lines",
                    "(select sum(order_lines) from (select d.year_month, count(*) as order_lines from f_fact f "
                    "join dim_date d on f.date_key = d.date_key group by d.year_month))",
                ),
                ("fact_lines", "(select count(*) from f_fact)"),
            ]
        ),
    ),
)
def check_trend(spark: SparkSession, root: str) -> DataFrame:
    """The monthly trend reconciles to the fact's row count, in one scan."""
    star = build_star(spark, root)
    by = (C.TOTAL,)
    days = A.day_sums(C.with_total(star.fact, ["date_key"], ["quantity", "net_amount"]), *by)
    months = A.month_sums(days, star.date_dim("date_key", "year_month"), "left", by)
    lines, total = F.col("order_lines"), F.col(C.TOTAL)
    return C.measured(
        months,
        trend_order_lines=F.sum(F.when(~total & F.col("year_month").isNotNull(), lines)),
        fact_lines=F.sum(F.when(total, lines)),
    )


_NULL_TABLES = [
    ("fact", "f_fact", FACT_SALES_COLUMNS),
    ("dim_date", "dim_date", [f.name for f in DIM_DATE.fields]),
    ("dim_product", "f_dim_product", ["product_key", "product_id", "product_name", "category", "subcategory", "brand", "unit_price"]),
    ("dim_store", "f_dim_store", ["store_key", "store_id", "store_name", "city", "region", "country"]),
    ("dim_customer", "f_dim_customer", DIM_CUSTOMER_COLS.split(", ")),
]


def _nulls_sql(table: str, cols: list[str]) -> str:
    return "(select " + " + ".join(f"count(*) filter (where {c} is null)" for c in cols) + f" from {table})"


@register(
    "check_not_null",
    with_ctes(
        ["f_fact", "dim_date", "f_dim_product", "f_dim_store", "f_dim_customer"],
        _metric_union(
            [(f"{n}_nulls", _nulls_sql(t, cols)) for n, t, cols in _NULL_TABLES]
            + [
                ("duplicate_date_key", "(select count(*) from (select date_key from dim_date group by 1 having count(*) > 1))"),
                ("duplicate_product_key", "(select count(*) from (select product_key from f_dim_product group by 1 having count(*) > 1))"),
                ("duplicate_store_key", "(select count(*) from (select store_key from f_dim_store group by 1 having count(*) > 1))"),
                ("duplicate_customer_key", "(select count(*) from (select customer_key from f_dim_customer group by 1 having count(*) > 1))"),
            ]
        ),
    ),
)
def check_not_null(spark: SparkSession, root: str) -> DataFrame:
    """NOT NULL and primary-key uniqueness (engine-enforced in the DDL)."""
    star = build_star(spark, root, with_sale_key=True)
    return C.metrics(
        [
            C.not_null(star.fact, "fact"),
            C.not_null(star.dim_date, "dim_date"),
            C.not_null(star.dim_product, "dim_product"),
            C.not_null(star.dim_store, "dim_store"),
            C.not_null(star.dim_customer, "dim_customer"),
            C.duplicate_keys(star.dim_date, ["date_key"], "duplicate_date_key"),
            C.duplicate_keys(star.dim_product, ["product_key"], "duplicate_product_key"),
            C.duplicate_keys(star.dim_store, ["store_key"], "duplicate_store_key"),
            C.duplicate_keys(star.dim_customer, ["customer_key"], "duplicate_customer_key"),
        ]
    )


@register(
    "check_coverage",
    with_ctes(
        ["f_dim_product", "f_fact", "dim_date"],
        f""", q1 as (
  select distinct p.category from f_fact f join f_dim_product p on f.product_key = p.product_key
  join dim_date d on f.date_key = d.date_key
  where d.year_month between '{Q1_MONTHS[0]}' and '{Q1_MONTHS[-1]}'
)
"""
        + _metric_union(
            [
                ("category_missing", "(select count(*) from (select distinct category from f_dim_product except all select category from q1))"),
                ("category_extra", "(select count(*) from (select category from q1 except all select distinct category from f_dim_product))"),
            ]
        ),
    ),
)
def check_coverage(spark: SparkSession, root: str) -> DataFrame:
    """The crosstab lists every product category, and nothing else."""
    star = build_star(spark, root)
    q1 = A.category_month_revenue(star, Q1_MONTHS, Q1_TOTAL)
    return C.same_rows(star.dim_product.select("category").distinct(), q1.select("category"), "category")


@register(
    "check_orphans_unknown",
    with_ctes(
        ["f_fact_unknown", "dim_date", "f_dim_product", "f_dim_store", "f_dim_customer_late"],
        """, seeded as (
  select customer_key from f_dim_customer_late union all select -1
)
"""
        + _metric_union(
            [
                ("unknown_lines", "(select count(*) from f_fact_unknown where customer_key = -1)"),
                (
                    "orphan_customer_key",
                    "(select count(*) from f_fact_unknown f where not exists "
                    "(select 1 from seeded x where x.customer_key = f.customer_key))",
                ),
                (
                    "orphan_product_key",
                    "(select count(*) from f_fact_unknown f where not exists "
                    "(select 1 from f_dim_product x where x.product_key = f.product_key))",
                ),
                (
                    "orphan_store_key",
                    "(select count(*) from f_fact_unknown f where not exists "
                    "(select 1 from f_dim_store x where x.store_key = f.store_key))",
                ),
            ]
        ),
    ),
)
def check_orphans_unknown(spark: SparkSession, root: str) -> DataFrame:
    """D4 + T2: facts parked on -1 still have a parent, because every
    dimension carries the unknown member's seed row."""
    from starloom.operators.asof import with_unknown_member
    from starloom.schemas import UNKNOWN_KEY

    star = build_star(spark, root, late=True, mode="unknown")
    fact = star.fact
    orphans = C.orphans(
        fact,
        {
            "customer_key": with_unknown_member(star.dim_customer, CUSTOMER_SPEC, "customer_key"),
            "product_key": with_unknown_member(star.dim_product, None, "product_key"),
            "store_key": with_unknown_member(star.dim_store, None, "store_key"),
        },
    )
    return C.metrics([C.metric(fact, "unknown_lines", F.count_if(F.col("customer_key") == UNKNOWN_KEY)), orphans])


@register(
    "warehouse_build",
    with_ctes(
        ["f_dim_product", "f_dim_store", "f_dim_customer", "f_fact"],
        """select cast((select count(*) from f_dim_product) as bigint) as products,
  cast((select count(*) from f_dim_store) as bigint) as stores,
  cast((select count(distinct customer_id) from f_dim_customer) as bigint) as customers,
  cast((select count(*) from f_dim_customer) as bigint) as customer_versions,
  cast((select count(*) from f_fact) as bigint) as fact_rows,
  cast((select count(*) from f_fact) as bigint) as staged_lines,
  cast(0 as bigint) as duplicate_fact_keys, cast(0 as bigint) as orphans""",
    ),
)
def warehouse_build(spark: SparkSession, root: str) -> DataFrame:
    """K8: build the persisted warehouse, then report what it holds, with T1 and
    T2 (read back from the written tables). The unknown member's row, which each
    dimension stores, is no member."""
    from starloom.plans.warehouse import build, read_dimension, read_fact

    out = scratch_path(spark, "warehouse")
    build(spark, root, out)
    dims = {f"{n}_key": read_dimension(spark, f"{out}/dim_{n}") for n in ("product", "store", "customer")}
    members = {key: dim.where(F.col(key) != UNKNOWN_KEY) for key, dim in dims.items()}
    fact = read_fact(spark, f"{out}/fact_sales")
    parents = dims | {"date_key": spark.read.parquet(f"{out}/dim_date")}
    orphans = C.orphans(fact, parents).agg(F.sum("value").cast(C.VALUE).alias("value"))
    names = [
        "products", "stores", "customers", "customer_versions", "fact_rows", "staged_lines", "duplicate_fact_keys", "orphans",
    ]
    long = C.metrics(
        [
            C.count_rows(members["product_key"], "products"),
            C.count_rows(members["store_key"], "stores"),
            C.metric(members["customer_key"], "customers", F.count_distinct("customer_id")),
            C.count_rows(members["customer_key"], "customer_versions"),
            C.count_rows(fact, "fact_rows"),
            C.count_rows(spark.read.parquet(f"{out}/stg_sales"), "staged_lines"),
            C.duplicate_keys(fact, ["sale_key"], "duplicate_fact_keys"),
            orphans.select(F.lit("orphans").alias("metric"), "value"),
        ]
    )
    # (metric, value) rows turned into one row with an explicit pivot list
    wide = long.groupBy().pivot("metric", names).agg(F.first("value"))
    return wide.select(*[F.col(n).cast("bigint").alias(n) for n in names])


@register(
    "check_one_current",
    with_ctes(
        ["f_dim_customer"],
        _metric_union(
            [
                (
                    "members_not_one_current",
                    "(select count(*) from (select customer_id from f_dim_customer group by customer_id "
                    "having count(*) filter (where is_current) <> 1))",
                )
            ]
        ),
    ),
)
def check_one_current(spark: SparkSession, root: str) -> DataFrame:
    """T3 alone: exactly one current version per member."""
    dim = rebuild_history(src.customer_snapshots(Tables(spark, root)), CUSTOMER_SPEC)
    return C.one_current(dim, CUSTOMER_SPEC)


@register(
    "check_tiling",
    with_ctes(
        ["f_dim_customer"],
        """, t as (
  select *, lead(valid_from) over w as nxt, row_number() over w as rn
  from f_dim_customer window w as (partition by customer_id order by version)
)
"""
        + _metric_union(
            [
                ("gap", "(select count(*) from t where nxt is not null and valid_to <> nxt)"),
                ("last_not_open", "(select count(*) from t where nxt is null and valid_to <> date '9999-12-31')"),
                ("wrong_current", "(select count(*) from t where is_current <> (nxt is null))"),
                ("empty_window", "(select count(*) from t where valid_from >= valid_to)"),
                ("version_hole", "(select count(*) from t where version <> rn)"),
            ]
        ),
    ),
)
def check_tiling(spark: SparkSession, root: str) -> DataFrame:
    """T4 alone: validity windows tile, only the last is open and current."""
    dim = rebuild_history(src.customer_snapshots(Tables(spark, root)), CUSTOMER_SPEC)
    return C.tiling(dim, CUSTOMER_SPEC)
