"""Source extracts for the retail star, derived from the driver's tables.

Customers arrive as dated snapshots. The change rules (which members move
segment or nation at which snapshot, who gets a new e-mail) are fixed values
of the test fixture; everything else is read from the tables, so the work
grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.money import net_of_discount, to_money, to_price, to_rate
from starloom.sources.tables import Tables

# Fixed values of the fixture: snapshot dates (oldest first), the segment
# rotation applied to a moving member, and the e-mail domain.
SNAPSHOT_DATES = (dt.date(1995, 1, 1), dt.date(1998, 7, 1), dt.date(2000, 1, 1))
SEGMENT_ROTATION = {
    "AUTOMOBILE": "BUILDING",
    "BUILDING": "FURNITURE",
    "FURNITURE": "HOUSEHOLD",
    "HOUSEHOLD": "MACHINERY",
}
SEGMENT_ROTATION_DEFAULT = "AUTOMOBILE"
EMAIL_DOMAIN = "@example.test"
NATIONS = 25  # nation keys 0..24; a moving member shifts to the next one

# Late variant: members with customer_id % LATE_MODULUS == LATE_REMAINDER are
# missing from the first snapshot (their facts before the second snapshot
# have no version).
LATE_MODULUS = 20
LATE_REMAINDER = 19

# Product reclassification for the Type-2 product dimension: on
# PRODUCT_SNAPSHOT_DATES[1], parts with product_id % 10 == 4 move category.
PRODUCT_SNAPSHOT_DATES = (dt.date(1995, 1, 1), dt.date(1999, 1, 1))
PRODUCT_RECLASS_SUFFIX = " II"


def geography(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def _rotate_segment(seg: Column) -> Column:
    out = None
    for src, dst in SEGMENT_ROTATION.items():
        out = F.when(seg == src, dst) if out is None else out.when(seg == src, dst)
    return out.otherwise(SEGMENT_ROTATION_DEFAULT)


def customer_snapshots(t: Tables, late: bool = False) -> DataFrame:
    """All snapshots stacked: (as_of, customer_id, names, email, segment, city, region).

    The snapshot dates are expanded per customer with a generator (no join).
    """
    schedule = F.array(
        *[F.struct(F.lit(d).alias("as_of"), F.lit(i + 1).alias("n")) for i, d in enumerate(SNAPSHOT_DATES)]
    )
    c = t.customer.select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.explode(schedule).alias("s")
    ).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "s.as_of", "s.n")
    m10 = F.col("c_custkey") % 10
    n = F.col("n")
    seg_moves = ((n == 2) & m10.isin(0, 3)) | ((n == 3) & (m10 == 3))
    geo_moves = (n >= 2) & m10.isin(3, 6)
    new_email = (n == 3) & m10.isin(0, 5)
    c = c.select(
        "as_of",
        F.col("c_custkey").alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 1 << 30).alias("last_name"),
        F.concat(
            F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
            F.when(new_email, F.lit(".new")).otherwise(F.lit("")),
            F.lit(EMAIL_DOMAIN),
        ).alias("email"),
        F.when(seg_moves, _rotate_segment(F.col("c_mktsegment")))
        .otherwise(F.col("c_mktsegment"))
        .alias("segment"),
        F.when(geo_moves, (F.col("c_nationkey") + 1) % NATIONS)
        .otherwise(F.col("c_nationkey"))
        .alias("_nation"),
    )
    if late:
        c = c.where(
            ~((F.col("as_of") == F.lit(SNAPSHOT_DATES[0]))
              & (F.col("customer_id") % LATE_MODULUS == LATE_REMAINDER))
        )
    geo = geography(t)
    return c.join(geo, F.col("_nation") == F.col("n_nationkey")).select(
        "as_of",
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "segment",
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
    )


def product_source(t: Tables) -> DataFrame:
    p = t.part
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        to_price("p_retailprice").alias("unit_price"),
    )


def product_snapshots(t: Tables) -> DataFrame:
    """Two product snapshots; the second reclassifies a tenth of the parts."""
    base = product_source(t)
    schedule = F.array(*[F.lit(d) for d in PRODUCT_SNAPSHOT_DATES])
    rows = base.select("*", F.explode(schedule).alias("as_of"))
    moves = (F.col("as_of") == F.lit(PRODUCT_SNAPSHOT_DATES[1])) & (F.col("product_id") % 10 == 4)
    return rows.select(
        "as_of",
        "product_id",
        "product_name",
        F.when(moves, F.concat("category", F.lit(PRODUCT_RECLASS_SUFFIX)))
        .otherwise(F.col("category"))
        .alias("category"),
        "subcategory",
        "brand",
        "unit_price",
    )


def store_source(t: Tables) -> DataFrame:
    geo = geography(t)
    return t.supplier.join(geo, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
    )


def staged_sales(
    t: Tables,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
) -> DataFrame:
    """The sales extract: one row per order line with natural keys.

    ``date_from``/``date_to`` (inclusive/exclusive) restrict order dates; the
    filter lands on the orders scan as a pushed Parquet predicate.
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    ts_type = o.schema["o_orderdate"].dataType

    def bound(d: dt.date):
        # literal of the column's own type: no zone conversion, still pushed to Parquet
        return F.lit(f"{d.isoformat()} 00:00:00").cast(ts_type)

    if date_from is not None:
        o = o.where(F.col("o_orderdate") >= bound(date_from))
    if date_to is not None:
        o = o.where(F.col("o_orderdate") < bound(date_to))
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    price = t.part.select("p_partkey", "p_retailprice")
    gross = to_money("l_extendedprice")
    disc = to_rate("l_discount")
    return (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(price, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            to_price("p_retailprice").alias("unit_price"),
            disc.alias("discount_pct"),
            gross.alias("gross_amount"),
            net_of_discount(gross, disc).alias("net_amount"),
        )
    )


def staged_returns(t: Tables) -> DataFrame:
    """A second fact process (returned lines) sharing the product and date
    dimensions with sales, for drill-across."""
    li = t.lineitem.where(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    o = t.orders.select("o_orderkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("returned_quantity"),
        to_money("l_extendedprice").alias("returned_gross"),
    )


def shipments(t: Tables) -> DataFrame:
    """Order-line shipments (order date and ship date) for milestone facts."""
    li = t.lineitem.select("l_orderkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )
