"""Incremental loads with Structured Streaming.

The same operators as the batch load, fed by files that keep arriving:

* :func:`resolve_stream` - staged sales files -> stream-static point-in-time
  lookup (unknown member -1, so a late member never drops a line) -> the
  month-partitioned fact through the file sink, whose commit log makes the
  append exactly-once across restarts.
* :func:`merge_snapshot_stream` - snapshot files -> Type-2 merge per
  micro-batch (``foreachBatch``). ``foreachBatch`` may replay a batch after a
  failure; the merge is idempotent (a re-applied snapshot is "unchanged") and a
  dimension version only becomes visible when its write commits, so a replay
  cannot duplicate versions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.predicates import any_changed_cols
from starloom.operators.facts import resolve_keys
from starloom.operators.scd import SnapshotRejected, validate_members
from starloom.plans.warehouse import FACT_PARTITION, merge_into, read_dimension
from starloom.schemas import CUSTOMER_SPEC, Scd2Spec
from starloom.sources.csv_stage import DATE_FORMAT

FACT_STREAM_COLUMNS = [
    "order_id",
    "line_number",
    "date_key",
    "product_key",
    "store_key",
    "customer_key",
    "quantity",
    "net_amount",
]


def staged_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Files landing in ``path`` as a stream with a fixed schema."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    if fmt == "csv":
        # as in the batch load: header names have to line up with the schema
        reader = reader.option("header", True).option("enforceSchema", False)
        reader = reader.option("dateFormat", DATE_FORMAT).option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def resolve_stream(
    stream: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    dim_customer: DataFrame,
    broadcast: frozenset[str] = frozenset(),
) -> DataFrame:
    """Stream-static resolve; misses map to -1 (an inner join would lose them)."""
    resolved = resolve_keys(stream, dim_product, dim_store, dim_customer, "unknown", broadcast=broadcast)
    return resolved.select(*FACT_STREAM_COLUMNS).withColumn(
        FACT_PARTITION, (F.col("date_key") / 100).cast("int")
    )


def run_fact_stream(resolved: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """Append to the month-partitioned fact through the exactly-once file sink."""
    writer = (
        resolved.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy(FACT_PARTITION)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _without_applied(dim: DataFrame, one: DataFrame, as_of: dt.date, spec: Scd2Spec) -> tuple[DataFrame, int]:
    """The snapshot's rows that are still to be merged, and how many are applied already.

    Decided per member, so parts of one snapshot may come in any number of
    batches. Where a member has versions that began later, its row is applied
    if the version of that date says the same; any other such row would change
    history behind a later version, and is refused with the number of them.
    """
    nk, day = spec.natural_key, F.lit(as_of).cast("date")
    later = dim.where(F.col(spec.valid_from) > day).select(nk).distinct()
    behind = one.join(later, nk, "left_semi")
    then = dim.where((F.col(spec.valid_from) <= day) & (day < F.col(spec.valid_to)))
    then = then.select(nk, *[F.col(c).alias(f"_then_{c}") for c in spec.tracked], F.lit(True).alias("_then"))
    same = F.col("_then").isNotNull() & ~any_changed_cols((F.col(f"_then_{c}"), F.col(c)) for c in spec.tracked)
    found = behind.join(then, nk, "left").withColumn("_same", same)
    n = found.agg(F.count_if("_same").alias("applied"), F.count_if(~F.col("_same")).alias("refused")).first()
    if n["refused"]:
        some = [str(r[0]) for r in found.where(~F.col("_same")).select(nk).limit(20).collect()]
        raise SnapshotRejected(
            f"snapshot {as_of} came late: {n['refused']} rows differ from members whose versions began after it: "
            + ", ".join(some)
        )
    return (one.join(later, nk, "left_anti") if n["applied"] else one), n["applied"]


def apply_snapshot_batch(
    batch: DataFrame, dim_path: str, spec: Scd2Spec = CUSTOMER_SPEC, as_of_col: str = "as_of"
) -> list:
    """One micro-batch: merge its snapshots oldest first; write a new
    dimension version only when something changed. Rows that were applied
    already, also where later snapshots followed, are left out member by
    member and count as unchanged; a late part of a snapshot adds its new
    members, and late rows that differ from a later history are refused.
    Returns the members per action of each snapshot."""
    stats = []
    dates = sorted(r[0] for r in batch.select(as_of_col).distinct().collect())  # one per snapshot
    for d in dates:
        current = read_dimension(batch.sparkSession, dim_path)
        day = d if type(d) is dt.date else d.date()
        one, applied = batch.where(F.col(as_of_col) == F.lit(d)), 0
        if current is not None and not current.where(F.col(spec.valid_from) > F.lit(day)).isEmpty():
            # members are told apart by their rows, so copies are refused before any is left out
            validate_members(one, spec.natural_key)
            one, applied = _without_applied(current, one, day, spec)
        res = merge_into(batch.sparkSession, dim_path, one, day, spec)
        stats.append(res.counts | {"unchanged": res.counts["unchanged"] + applied})
    return stats


def merge_snapshot_stream(
    snapshots: DataFrame,
    dim_path: str,
    checkpoint: str,
    spec: Scd2Spec = CUSTOMER_SPEC,
    as_of_col: str = "as_of",
    available_now: bool = True,
):
    """Apply each arriving snapshot (oldest first within a micro-batch)."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_snapshot_batch(batch, dim_path, spec, as_of_col)

    writer = snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def daily_activity(events: DataFrame, entity: str, ts: str, amount: str, lateness: str = "2 days") -> DataFrame:
    """Watermarked per-entity daily sums (the input of the periodic snapshot).

    Events later than ``lateness`` behind the newest event are dropped and
    their day's state is released; everything else lands in its calendar
    day (taken from ``ts`` itself, so a zone-less ``ts`` keeps its wall-clock
    date whatever the session time zone).
    """
    # the reported day is the event's own calendar date; the window only
    # drives the watermark and state eviction
    events = events.withColumn("_day", F.col(ts).cast("date"))
    if events.schema[ts].dataType.typeName() == "timestamp_ntz":
        # the instant whose UTC reading is the wall clock: day windows (UTC
        # aligned) then match calendar days whatever the session time zone
        zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
        events = events.withColumn(ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    return (
        events.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 day").alias("w"), F.col(entity), F.col("_day"))
        .agg(
            F.sum(F.col(amount).cast("decimal(18,2)")).alias("day_amount"),
            F.count(F.lit(1)).alias("day_events"),
        )
        .select(entity, F.col("_day").alias("day"), "day_amount", "day_events")
    )


def run_upserts(updates: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """Update-mode sink: every micro-batch's changed rows are appended with
    their batch id; readers keep the latest batch per key
    (:func:`starloom.operators.facts.latest_per_merge_key`). A replayed batch
    rewrites its own ``batch_id`` folder, so replays do not duplicate."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = updates.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_daily_deltas(
    events: DataFrame, entity: str, ts: str, amount: str, out: str, checkpoint: str, available_now: bool = True
):
    """Per-entity daily sums of every micro-batch, kept by batch id.

    No watermark: an event of any age adds to its day, whatever the order and
    number of files, and no state grows with the stream. A replayed batch
    rewrites its own folder. :func:`merged_days` adds the batches up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        days = batch.groupBy(entity, F.col(ts).cast("date").alias("day")).agg(
            F.sum(F.col(amount).cast("decimal(18,2)")).alias("day_amount"), F.count(F.lit(1)).alias("day_events")
        )
        days.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def merged_days(deltas: DataFrame, entity: str) -> DataFrame:
    """The daily sums over all batches written by :func:`run_daily_deltas`."""
    return deltas.groupBy(entity, "day").agg(
        F.sum("day_amount").cast("decimal(38,2)").alias("day_amount"), F.sum("day_events").alias("day_events")
    )
