"""Stored snapshot facts: D17 by batch, D16 day by day.

Both are tables in published parts (plans/publish.py), so a batch or a day is
replaced as a whole by one switch, and a load that dies changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.facts import accumulated, accumulating_snapshot, carry_forward
from starloom.plans.publish import latest, new_load, publish, read_table, with_months, write_months

CONTRIBUTIONS, BALANCES = "contributions", "balances"
BATCH, DAY = "batch", "day"


def _put(rows: DataFrame, store: str, table: str, part: str, value: str) -> None:
    spark = rows.sparkSession
    before = latest(spark, store)
    load, tagged = new_load(before), rows.withColumn(part, F.lit(value))
    written = write_months(tagged, store, table, load, part)
    publish(spark, store, with_months(before, table, load, written, lambda v: v == value, tagged.schema, part))


def fold_batch(lines: DataFrame, store: str, batch: str) -> None:
    """Store what a batch of shipments contributes to each order, under the
    batch's name. A batch that comes again replaces its contributions."""
    _put(accumulating_snapshot(lines), store, CONTRIBUTIONS, BATCH, batch)


def accumulating_fact(spark: SparkSession, store: str) -> DataFrame:
    """One row per order, added up over the stored batches. Lines without an
    order id are one row."""
    found = read_table(spark, store, CONTRIBUTIONS, latest(spark, store), part=BATCH)
    if found is None:
        raise FileNotFoundError(f"{store} has no batches")
    return accumulated(found)


def close_day(events: DataFrame, store: str, entity: str, ts: str, amount: str, day: dt.date) -> None:
    """Store ``day``'s closing balances, from those of the day before and the
    day's events. Reads one stored day. Closing a day again replaces it; days have
    to be closed in order, and the first one closed opens the balances."""
    spark, wanted = events.sparkSession, (day - dt.timedelta(days=1)).isoformat()
    live = latest(spark, store)
    stored = live.months.get(BALANCES, {})
    if stored and wanted not in stored and min(stored) < day.isoformat():
        raise ValueError(f"{wanted} is not closed; close the days in order")
    previous = read_table(spark, store, BALANCES, live, {wanted}, DAY) if wanted in stored else None
    _put(carry_forward(previous, events, entity, ts, amount, day), store, BALANCES, DAY, day.isoformat())


def closed_days(spark: SparkSession, store: str, days=None) -> DataFrame:
    """The stored balances of ``days`` (dates; all when not given)."""
    wanted = None if days is None else {d.isoformat() for d in days}
    found = read_table(spark, store, BALANCES, latest(spark, store), wanted, DAY)
    if found is None:
        raise FileNotFoundError(f"{store} has no closed day")
    return found.drop(DAY)
