"""Streaming loads: replay safety and the unknown member in the stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators.scd import SnapshotRejected
from starloom.plans.warehouse import committed_versions, read_dimension
from starloom.schemas import Scd2Spec
from starloom.streaming.loads import (
    apply_snapshot_batch,
    daily_activity,
    merged_days,
    run_daily_deltas,
    run_upserts,
)

SPEC = Scd2Spec(natural_key="id", tracked=("seg",), attributes=("seg",), key="k")
D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 6, 1)


def test_replayed_snapshot_batch_adds_nothing(spark, scratch):
    path = f"{scratch}/dim"
    first = spark.createDataFrame([(D1, 1, "A"), (D1, 2, "B")], "as_of date, id int, seg string")
    second = spark.createDataFrame([(D2, 1, "C"), (D2, 2, "B")], "as_of date, id int, seg string")
    apply_snapshot_batch(first, path, SPEC)
    apply_snapshot_batch(second, path, SPEC)
    versions = committed_versions(spark, path)
    rows = read_dimension(spark, path).count()
    stats = apply_snapshot_batch(second, path, SPEC)  # foreachBatch replay after a failure
    assert stats[0] == {"inserted": 0, "versioned": 0, "unchanged": 2}
    assert committed_versions(spark, path) == versions
    assert read_dimension(spark, path).count() == rows == 3


def test_late_event_beyond_watermark_is_dropped(spark, scratch):
    src = f"{scratch}/events"
    base = dt.datetime(2024, 1, 10)
    spark.createDataFrame(
        [(1, base, 1, 5.0), (2, base + dt.timedelta(days=5), 1, 7.0)], "event_id long, ts timestamp, user_id long, value double"
    ).coalesce(1).write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    out, ck = f"{scratch}/out", f"{scratch}/ck"
    q = run_upserts(daily_activity(stream, "user_id", "ts", "value", "1 day"), out, ck)
    q.awaitTermination()
    # an event 4 days behind the newest one arrives later: beyond the 1-day watermark
    spark.createDataFrame([(3, base + dt.timedelta(days=1), 1, 100.0)], schema).coalesce(1).write.parquet(f"{src}/b")
    q = run_upserts(daily_activity(stream, "user_id", "ts", "value", "1 day"), out, ck)
    q.awaitTermination()
    days = {r["day"] for r in spark.read.parquet(out).collect()}
    assert dt.date(2024, 1, 11) not in days
    assert {dt.date(2024, 1, 10), dt.date(2024, 1, 15)} <= days


def test_replayed_batch_of_several_snapshots_adds_nothing(spark, scratch):
    path = f"{scratch}/dim"
    batch = spark.createDataFrame(
        [(D1, 1, "A"), (D1, 2, "B"), (D2, 1, "C"), (D2, 2, "B")], "as_of date, id int, seg string"
    )
    assert len(apply_snapshot_batch(batch, path, SPEC)) == 2
    before = sorted(map(str, read_dimension(spark, path).collect()))
    apply_snapshot_batch(batch, path, SPEC)
    assert sorted(map(str, read_dimension(spark, path).collect())) == before


def test_parts_of_snapshots_in_several_batches_keep_every_member(spark, scratch):
    rows = [(D1, 1, "A"), (D1, 2, "B"), (D2, 1, "C"), (D2, 2, "B"), (D1, 3, "A"), (D1, 4, None), (D2, 3, "C"), (D2, 4, None)]
    table = spark.createDataFrame(rows, "as_of date, id int, seg string")
    whole, parts = f"{scratch}/whole", f"{scratch}/parts"
    apply_snapshot_batch(table, whole, SPEC)
    for ids in ("id < 3", "id > 2"):  # the second batch brings the rest of both snapshots
        apply_snapshot_batch(table.where(ids), parts, SPEC)
    seen = [sorted(map(str, read_dimension(spark, p).drop("k").collect())) for p in (whole, parts)]
    assert seen[0] == seen[1] and len(seen[0]) == 6
    versions = committed_versions(spark, parts)
    stats = apply_snapshot_batch(table, parts, SPEC)  # replays are counted, and add nothing
    assert stats == [{"inserted": 0, "versioned": 0, "unchanged": 4}] * 2
    assert committed_versions(spark, parts) == versions


def test_late_rows_against_a_later_history_are_refused(spark, scratch):
    path = f"{scratch}/dim"
    table = spark.createDataFrame([(D1, 1, "A"), (D2, 1, "C"), (D2, 2, "B")], "as_of date, id int, seg string")
    apply_snapshot_batch(table, path, SPEC)
    late = spark.createDataFrame([(D1, 1, "C"), (D1, 2, "B"), (D1, 3, "B")], "as_of date, id int, seg string")
    with pytest.raises(SnapshotRejected, match="2 rows"):
        apply_snapshot_batch(late, path, SPEC)
    assert read_dimension(spark, path).count() == 3


def test_daily_sums_keep_every_event_in_any_number_of_files(spark, scratch):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=(i * 37) % 90), i % 3 or None, 1.0) for i in range(300)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double")
    seen = []
    for files in (1, 8):
        src, out, ck = (f"{scratch}/{x}{files}" for x in ("src", "out", "ck"))
        events.repartition(files).write.parquet(src)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
        run_daily_deltas(stream, "user_id", "ts", "value", out, ck).awaitTermination()
        seen.append(sorted(map(str, merged_days(spark.read.parquet(out), "user_id").collect())))
        assert merged_days(spark.read.parquet(out), "user_id").agg(F.sum("day_events")).first()[0] == len(rows)
    assert seen[0] == seen[1]
