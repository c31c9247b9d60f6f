"""Registered streaming queries: the incremental form of the loads, run to
completion with ``availableNow`` and read back from their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.oracle import with_ctes
from starloom.plans.registry import DIM_CUSTOMER_COLS, register
from starloom.plans.star import build_star
from starloom.plans.warehouse import read_dimension
from starloom.schemas import CUSTOMER_SPEC, STG_SALES
from starloom.session import scratch_path
from starloom.sources import star_inputs as src
from starloom.sources.tables import Tables
from starloom.streaming.loads import (
    merge_snapshot_stream,
    resolve_stream,
    run_fact_stream,
    staged_stream,
)


@register(
    "fact_stream_resolve",
    with_ctes(
        ["f_stg_sales", "f_dim_product", "f_dim_store", "f_dim_customer_late"],
        """select s.order_id, s.line_number,
  cast(year(s.order_date) * 10000 + month(s.order_date) * 100 + day(s.order_date) as int) as date_key,
  p.product_key, t.store_key, cast(coalesce(c.customer_key, -1) as bigint) as customer_key,
  s.quantity, s.net_amount,
  cast((year(s.order_date) * 10000 + month(s.order_date) * 100 + day(s.order_date)) // 100 as int) as month_key
from f_stg_sales s
join f_dim_product p on p.product_id = s.product_id
join f_dim_store t on t.store_id = s.store_id
left join f_dim_customer_late c on c.customer_id = s.customer_id
  and s.order_date >= c.valid_from and s.order_date < c.valid_to""",
    ),
)
def fact_stream_resolve(spark: SparkSession, root: str) -> DataFrame:
    """Staged extract files -> streaming point-in-time resolve -> file sink.

    Uses the late dimension, so the unknown member (-1) carries the lines of
    members not yet known instead of dropping them.
    """
    star = build_star(spark, root, late=True, mode="unknown")
    landing = scratch_path(spark, "stg_landing")
    star.stg_sales.write.mode("overwrite").parquet(landing)
    stream = staged_stream(spark, landing, STG_SALES)
    out, ck = scratch_path(spark, "fact_stream"), scratch_path(spark, "fact_stream_ck")
    q = run_fact_stream(
        resolve_stream(stream, star.dim_product, star.dim_store, star.dim_customer, star.broadcastable),
        out,
        ck,
    )
    q.awaitTermination()
    return spark.read.parquet(out)


@register(
    "scd2_stream",
    with_ctes(["f_dim_customer"], f"select {DIM_CUSTOMER_COLS} from f_dim_customer"),
)
def scd2_stream(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot files -> Type-2 merge per micro-batch -> versioned dimension."""
    snaps = src.customer_snapshots(Tables(spark, root))
    landing = scratch_path(spark, "snapshot_landing")
    # snapshots land one after another, each in its own as_of=... folder
    for d in src.SNAPSHOT_DATES:
        snaps.where(F.col("as_of") == F.lit(d)).drop("as_of").write.mode("overwrite").parquet(f"{landing}/as_of={d}")
    schema = spark.read.parquet(landing).schema
    stream = spark.readStream.schema(schema).parquet(landing)
    dim_path, ck = scratch_path(spark, "dim_customer"), scratch_path(spark, "dim_customer_ck")
    q = merge_snapshot_stream(stream, dim_path, ck, CUSTOMER_SPEC)
    q.awaitTermination()
    return read_dimension(spark, dim_path).select(*[c.strip() for c in DIM_CUSTOMER_COLS.split(",")])


@register(
    "daily_activity_stream",
    """select user_id, cast(ts as date) as day, sum(cast(value as decimal(18,2))) as day_amount,
  count(*) as day_events
from events group by user_id, cast(ts as date)""",
)
def daily_activity_stream(spark: SparkSession, root: str) -> DataFrame:
    """Events in many files, in no order -> daily sums per micro-batch, added
    up when read: no event is too late to count."""
    from starloom.streaming.loads import merged_days, run_daily_deltas

    events = Tables(spark, root).events
    landing = scratch_path(spark, "events_landing")
    events.repartition(8).write.mode("overwrite").parquet(landing)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(landing)
    out, ck = scratch_path(spark, "daily_activity"), scratch_path(spark, "daily_activity_ck")
    q = run_daily_deltas(stream, "user_id", "ts", "value", out, ck)
    q.awaitTermination()
    return merged_days(spark.read.parquet(out), "user_id")
