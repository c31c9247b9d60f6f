"""Assemble the retail star from the input tables: dimensions are written as
they are keyed, the fact stays lazy.

Dimensions are built first (calendar, product, store, versioned customer),
then the fact is resolved against them, mirroring the load order a
warehouse requires (dimensions before facts).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.calendar import calendar
from starloom.operators.facts import resolve_fact, resolve_keys
from starloom.operators.keys import Keyed, dense_keys
from starloom.operators.scd import rebuild_history_counted, replay_snapshots, validate_members
from starloom.schemas import CUSTOMER_SPEC
from starloom.session import checkpoint_dir
from starloom.sources import star_inputs as src
from starloom.sources.tables import Tables

# A calendar is broadcast only while it stays below this many days, and a
# dimension only while its exact row count (known from key assignment) stays
# below MAX_BROADCAST_ROWS; beyond that the join shuffles on the key and AQE
# may still convert it at run time from measured sizes.
MAX_BROADCAST_DAYS = 200_000
MAX_BROADCAST_ROWS = 1_000_000
ROWS_PER_KEY_PARTITION = 2_000_000  # rows numbered per range partition when the count is known
FACT_ROWS_PER_KEY_PARTITION = 5_000_000


@dataclass
class Star:
    tables: Tables
    dim_date: DataFrame
    dim_product: DataFrame
    dim_store: DataFrame
    dim_customer: DataFrame
    stg_sales: DataFrame
    fact: DataFrame
    calendar_days: int
    rows: dict[str, int]

    def date_dim(self, *cols: str) -> DataFrame:
        """The calendar projected to ``cols``; broadcast when its size allows."""
        d = self.dim_date.select(*cols) if cols else self.dim_date
        return F.broadcast(d) if self.calendar_days <= MAX_BROADCAST_DAYS else d

    def dim(self, name: str, *cols) -> DataFrame:
        """A dimension projected to ``cols``; broadcast under the row bound."""
        d = getattr(self, f"dim_{name}")
        d = d.select(*cols) if cols else d
        return F.broadcast(d) if name in self.broadcastable else d

    @property
    def broadcastable(self) -> frozenset[str]:
        return frozenset(n for n, r in self.rows.items() if r <= MAX_BROADCAST_ROWS)


def order_date_span(t: Tables) -> tuple[dt.date, dt.date]:
    """Whole calendar years covering every order date (one aggregate row)."""
    r = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    if r["lo"] is None:
        raise ValueError("orders is empty: no calendar span to build")
    return dt.date(r["lo"].year, 1, 1), dt.date(r["hi"].year, 12, 31)


def _key_partitions(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_KEY_PARTITION))


def product_dimension_counted(t: Tables) -> Keyed:
    """S3: product dimension, keys dense in product_id order.

    The source is checked for unique, non-NULL product ids first; that check
    also yields the exact row count, which sizes the key numbering.
    """
    source = src.product_source(t)
    n = validate_members(source, "product_id")
    k = dense_keys(source, ["product_id"], "product_key", partitions=_key_partitions(n))
    cols = ["product_key", "product_id", "product_name", "category", "subcategory", "brand", "unit_price"]
    return Keyed(k.df.select(*cols), k.rows)


def store_dimension_counted(t: Tables) -> Keyed:
    """Store dimension, keys dense in store_id order (source validated as for products)."""
    source = src.store_source(t)
    n = validate_members(source, "store_id")
    k = dense_keys(source, ["store_id"], "store_key", partitions=_key_partitions(n))
    cols = ["store_key", "store_id", "store_name", "city", "region", "country"]
    return Keyed(k.df.select(*cols), k.rows)


def product_dimension(t: Tables) -> DataFrame:
    return product_dimension_counted(t).df


def store_dimension(t: Tables) -> DataFrame:
    return store_dimension_counted(t).df


def customer_dimension_counted(t: Tables, method: str = "rebuild", late: bool = False) -> Keyed:
    snaps = src.customer_snapshots(t, late=late)
    if method == "replay":
        res = replay_snapshots(snaps, CUSTOMER_SPEC, dates=list(src.SNAPSHOT_DATES))
        return Keyed(res.dimension, res.rows)
    return rebuild_history_counted(snaps, CUSTOMER_SPEC)


def customer_dimension(t: Tables, method: str = "rebuild", late: bool = False) -> DataFrame:
    return customer_dimension_counted(t, method, late).df


def build_star(
    spark: SparkSession,
    root: str,
    *,
    customer_method: str = "rebuild",
    late: bool = False,
    mode: str = "inner",
    with_sale_key: bool = False,
    stg_from: dt.date | None = None,
    stg_to: dt.date | None = None,
) -> Star:
    t = Tables(spark, root)
    checkpoint_dir(spark)  # resolve once, before jobs start from several threads
    # the three dimensions are independent loads: submit their jobs together
    with ThreadPoolExecutor(max_workers=4) as pool:
        span_f = pool.submit(order_date_span, t)
        product_f = pool.submit(product_dimension_counted, t)
        store_f = pool.submit(store_dimension_counted, t)
        customer_f = pool.submit(customer_dimension_counted, t, customer_method, late)
        lo, hi = span_f.result()
        product, store, customer = product_f.result(), store_f.result(), customer_f.result()
    dim_date = calendar(spark, lo, hi)
    days = (hi - lo).days + 1
    rows = {"product": product.rows, "store": store.rows, "customer": customer.rows}
    stg = src.staged_sales(t, stg_from, stg_to)
    star = Star(t, dim_date, product.df, store.df, customer.df, stg, None, days, rows)  # type: ignore[arg-type]
    # staged lines never outnumber order lines (joins to orders and part only
    # drop rows; lookups are one-to-one); a Parquet row count is cheap, and it
    # sizes the sale-key numbering so the resolve is not run once more to sample
    parts = None
    if with_sale_key:
        parts = max(1, -(-t.lineitem.count() // FACT_ROWS_PER_KEY_PARTITION))
    star.fact = resolve_fact(
        stg,
        product.df,
        store.df,
        customer.df,
        mode=mode,
        with_sale_key=with_sale_key,
        broadcast=star.broadcastable,
        key_partitions=parts,
    )
    return star


def resolved_lines(star: Star, mode: str = "unknown") -> DataFrame:
    """Staged lines with resolved keys, natural keys kept (for repairs)."""
    return resolve_keys(
        star.stg_sales, star.dim_product, star.dim_store, star.dim_customer, mode, broadcast=star.broadcastable
    )
