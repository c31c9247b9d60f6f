"""Fact loading and fact shapes.

K7 resolve (inner / unknown-member modes), D5 late-arriving repair, D7
staging replay, D14 order rollup, D16 periodic snapshot, D17 accumulating
snapshot, D18 pre-aggregates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.money import exact_sum
from starloom.operators.asof import lookup_key, lookup_versions
from starloom.operators.keys import assign_dense_keys
from starloom.schemas import CUSTOMER_SPEC, FACT_SALES_COLUMNS, SALE_KEY_ORDER, UNKNOWN_KEY, Scd2Spec

def resolve_keys(
    stg: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    dim_customer: DataFrame,
    mode: str = "inner",
    customer_spec: Scd2Spec = CUSTOMER_SPEC,
    broadcast: frozenset[str] = frozenset(),
) -> DataFrame:
    """Staged lines with every surrogate key resolved; staging columns kept.

    ``mode="inner"`` drops a line when any lookup misses (parity load);
    ``mode="unknown"`` maps a miss to key -1 and keeps the line.
    ``broadcast`` names the dimensions whose size the caller has checked.
    """
    out = lookup_key(
        stg, dim_product, "product_id", "product_id", "product_key", mode, "product" in broadcast
    )
    out = lookup_key(out, dim_store, "store_id", "store_id", "store_key", mode, "store" in broadcast)
    out = lookup_versions(
        out, dim_customer, customer_spec, "customer_id", "order_date", mode, broadcast="customer" in broadcast
    )
    return out.withColumn("date_key", date_key("order_date"))


def resolve_fact(
    stg: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    dim_customer: DataFrame,
    mode: str = "inner",
    with_sale_key: bool = True,
    start_key: int = 1,
    broadcast: frozenset[str] = frozenset(),
    key_partitions: int | None = None,
) -> DataFrame:
    """K7: the sales fact at order-line grain.

    ``sale_key`` is numbered densely in (order_id, line_number, product_id,
    store_id, then measures) order by :func:`assign_dense_keys`. Queries that never read
    ``sale_key`` pass ``with_sale_key=False`` and stay fully lazy. When the
    staged row count is known (a written staging table), ``key_partitions``
    sizes the numbering; up to one partition spares the sampling pass.
    """
    resolved = resolve_keys(stg, dim_product, dim_store, dim_customer, mode, broadcast=broadcast)
    if not with_sale_key:
        cols = [c for c in FACT_SALES_COLUMNS if c != "sale_key"]
        return resolved.select(*cols)
    cols = [c for c in FACT_SALES_COLUMNS if c != "sale_key"]
    needed = resolved.select(*dict.fromkeys([*SALE_KEY_ORDER, *cols]))
    keyed = assign_dense_keys(
        needed, list(SALE_KEY_ORDER), "sale_key", start=start_key, partitions=key_partitions, keep=cols
    )
    return keyed.select(*FACT_SALES_COLUMNS)


def repair_late_members(
    resolved: DataFrame,
    dim_customer: DataFrame,
    spec: Scd2Spec = CUSTOMER_SPEC,
    fact_key: str = "customer_id",
    event_date: str = "order_date",
) -> DataFrame:
    """Re-resolve lines parked on the unknown member.

    ``resolved`` keeps the natural key and event date (see
    :func:`resolve_keys`). A parked line takes the version in force on its
    date; when the member's first known version starts after the date, the
    line is attributed to that first version (the member existed, the
    warehouse learnt of it late). Lines of still-unknown members stay at -1.
    Only the parked lines are looked up again.
    """
    key = spec.key
    parked = resolved.where(F.col(key) == UNKNOWN_KEY).drop(key)
    settled = resolved.where(F.col(key) != UNKNOWN_KEY)
    in_force = lookup_versions(parked, dim_customer, spec, fact_key, event_date, "unknown", "_in_force")
    first = dim_customer.where(F.col(spec.version) == 1).select(
        F.col(spec.natural_key).alias("_f_nk"),
        F.col(key).alias("_f_key"),
        F.col(spec.valid_from).alias("_f_from"),
    )
    early = in_force.join(
        first,
        (F.col(fact_key) == F.col("_f_nk")) & (F.col(event_date) < F.col("_f_from")),
        "left",
    )
    repaired_key = F.when(F.col("_in_force") != UNKNOWN_KEY, F.col("_in_force")).otherwise(
        F.coalesce(F.col("_f_key"), F.lit(UNKNOWN_KEY).cast("long"))
    )
    repaired = early.select(*[F.col(c) for c in parked.columns], repaired_key.alias(key))
    return settled.unionByName(repaired.select(*settled.columns))


def latest_per_merge_key(
    batches: DataFrame, merge_key: Sequence[str], batch_col: str
) -> DataFrame:
    """A replayed batch replaces earlier deliveries of the same merge key.

    For every merge key only the rows of the latest batch that delivered it
    survive (all of them, so a key repeated inside one extract is neither
    lost nor arbitrarily picked). The latest batch per key comes from a hash
    aggregate with map-side partial maxima; a left-semi join on (key, batch)
    keeps the rows, and AQE splits a hot key's partition in that join.
    """
    names = [f"_key_{i}" for i in range(len(merge_key))]
    latest = batches.groupBy(*[F.col(c).alias(n) for c, n in zip(merge_key, names, strict=True)]).agg(
        F.max(batch_col).alias("_latest")
    )
    same = F.col(batch_col) == F.col("_latest")
    for c, n in zip(merge_key, names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(n))  # a NULL key is a key like any other
    kept = batches.join(latest, same, "left_semi")
    return kept.select(*[c for c in batches.columns if c != batch_col])


def order_rollup(fact: DataFrame) -> DataFrame:
    """Roll order lines up to the degenerate order dimension."""
    return fact.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("order_lines"),
        F.sum("quantity").cast("bigint").alias("units"),
        exact_sum("gross_amount").alias("gross_amount"),
        exact_sum("net_amount").alias("net_amount"),
    )


def accumulating_snapshot(lines: DataFrame) -> DataFrame:
    """One row per order with its milestone dates filled in so far."""
    return lines.groupBy("order_id").agg(
        F.min("order_date").alias("order_date"),
        F.min("ship_date").alias("first_ship_date"),
        F.max("ship_date").alias("last_ship_date"),
        F.count(F.lit(1)).alias("shipped_lines"),
    )


def accumulate(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """D17 merge: fold a new batch's milestones into the accumulating fact. Lines
    without an order id are one row. A batch folded twice counts twice; stored
    batches (plans/snapshots.py) may come again."""
    e, b = existing.alias("e"), batch.alias("b")
    j = e.join(b, F.col("e.order_id").eqNullSafe(F.col("b.order_id")), "full_outer")

    def pick(fn, c):
        return F.coalesce(fn(F.col(f"e.{c}"), F.col(f"b.{c}")), F.col(f"e.{c}"), F.col(f"b.{c}"))

    return j.select(
        F.coalesce("e.order_id", "b.order_id").alias("order_id"),
        pick(F.least, "order_date").alias("order_date"),
        pick(F.least, "first_ship_date").alias("first_ship_date"),
        pick(F.greatest, "last_ship_date").alias("last_ship_date"),
        (F.coalesce("e.shipped_lines", F.lit(0)) + F.coalesce("b.shipped_lines", F.lit(0))).alias("shipped_lines"),
    )


def accumulated(contributions: DataFrame) -> DataFrame:
    """D17 from the contributions of any number of batches: one row per order."""
    return contributions.groupBy("order_id").agg(
        F.min("order_date").alias("order_date"),
        F.min("first_ship_date").alias("first_ship_date"),
        F.max("last_ship_date").alias("last_ship_date"),
        F.sum("shipped_lines").alias("shipped_lines"),
    )


def with_milestone_keys(acc: DataFrame) -> DataFrame:
    """Date keys and lags for the accumulating snapshot."""
    return acc.select(
        "order_id",
        date_key("order_date").alias("order_date_key"),
        date_key("first_ship_date").alias("first_ship_date_key"),
        date_key("last_ship_date").alias("last_ship_date_key"),
        F.datediff("first_ship_date", "order_date").alias("days_to_first_ship"),
        F.datediff("last_ship_date", "order_date").alias("days_to_last_ship"),
        F.col("shipped_lines").cast("bigint").alias("shipped_lines"),
    )


def periodic_snapshot(
    events: DataFrame,
    entity: str,
    ts: str,
    amount: str,
    period_end: dt.date,
) -> DataFrame:
    """One row per entity per day from its first activity to ``period_end``.

    The running balance is built from *daily* sums, so the window over an
    entity holds one row per active day, however many events a hot entity
    has. Days without activity are produced by expanding each active day
    into the run of days until the entity's next active day (a generator,
    not a grid join).
    """
    amount_dec = F.col(amount).cast("decimal(18,2)")
    # events after the period belong to the next snapshot
    events = events.where(F.col(ts).cast("date") <= F.lit(period_end))
    daily = events.groupBy(entity, F.col(ts).cast("date").alias("day")).agg(
        F.sum(amount_dec).alias("day_amount"), F.count(F.lit(1)).alias("day_events")
    )
    w = Window.partitionBy(entity).orderBy("day")
    nxt = F.coalesce(F.date_sub(F.lead("day").over(w), 1), F.lit(period_end).cast("date"))
    runs = daily.select(
        entity,
        "day",
        nxt.alias("_until"),
        F.sum("day_amount").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(38,2)").alias("balance"),
        "day_amount",
        "day_events",
    )
    days = runs.select(
        entity,
        F.explode(F.sequence("day", "_until")).alias("snapshot_date"),
        "day",
        "balance",
        "day_amount",
        "day_events",
    )
    active = F.col("snapshot_date") == F.col("day")
    return days.select(
        entity,
        "snapshot_date",
        date_key("snapshot_date").alias("date_key"),
        "balance",
        F.when(active, F.col("day_amount")).otherwise(F.lit(0).cast("decimal(38,2)")).cast("decimal(38,2)").alias("day_amount"),
        F.when(active, F.col("day_events")).otherwise(F.lit(0)).cast("bigint").alias("day_events"),
    )


def carry_forward(
    previous: DataFrame | None, events: DataFrame, entity: str, ts: str, amount: str, day: dt.date
) -> DataFrame:
    """D16, one day at a time: ``day``'s snapshot from the snapshot of the day before
    and the events of ``day`` (others are ignored). An entity without an event carries
    its balance; a new one starts. Neither older snapshots nor older events are read.
    """
    zero = F.lit(0).cast("decimal(38,2)")
    today = events.where(F.col(ts).cast("date") == F.lit(day)).groupBy(F.col(entity).alias("_e")).agg(
        F.sum(F.col(amount).cast("decimal(18,2)")).alias("_amount"), F.count(F.lit(1)).alias("_events")
    )
    if previous is None:
        joined = today.select("*", F.col("_e").alias(entity), F.lit(None).cast("decimal(38,2)").alias("balance"))
    else:
        before = previous.select(entity, "balance")
        joined = before.join(today, F.col(entity).eqNullSafe(F.col("_e")), "full_outer")
        joined = joined.withColumn(entity, F.coalesce(entity, "_e"))
    return joined.select(
        entity,
        F.lit(day).cast("date").alias("snapshot_date"),
        date_key(F.lit(day).cast("date")).alias("date_key"),
        # as in the window: a sum over nothing but nulls is null
        F.when(F.col("balance").isNull() & F.col("_amount").isNull(), F.lit(None))
        .otherwise(F.coalesce("balance", zero) + F.coalesce("_amount", zero))
        .cast("decimal(38,2)")
        .alias("balance"),
        F.when(F.col("_events").isNull(), zero).otherwise(F.col("_amount")).cast("decimal(38,2)").alias("day_amount"),
        F.coalesce("_events", F.lit(0)).cast("bigint").alias("day_events"),
    )


def preaggregate(
    fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame, how: str = "inner", by: Sequence[str] = ()
) -> DataFrame:
    """Month x category aggregate kept alongside the atomic fact.

    Pass the dimensions already projected (and broadcast-hinted if checked). ``how``
    "left" keeps lines without a month or category; ``by`` adds grouping columns.
    """
    months = dim_date.select("date_key", "year_month")
    cats = dim_product.select("product_key", "category")
    return (
        fact.join(months, "date_key", how)
        .join(cats, "product_key", how)
        .groupBy(*by, "year_month", "category")
        .agg(
            F.count(F.lit(1)).alias("order_lines"),
            F.sum("quantity").cast("bigint").alias("units"),
            exact_sum("gross_amount").alias("gross_amount"),
            exact_sum("net_amount").alias("net_amount"),
        )
    )
