"""K1: dense surrogate keys without a single-partition window.

``row_number() over (order by ...)`` with no partition clause funnels every
row through one task. Instead:

1. range-partition on the *whole* ordering key (Spark samples composite
   bounds, so one very frequent leading value is still split by the later
   columns) and sort inside each partition;
2. tag every row with its partition id and its position inside the partition;
3. materialise that as a table in the shared checkpoint folder, so the
   counting job and the numbering job read the very same rows (range bounds
   come from sampling and would not be reproducible across two jobs);
4. count rows per partition and turn the counts into running offsets: a
   table with one row per partition, broadcast to the tagged rows while it has
   at most ``MAX_BROADCAST_PARTS`` rows;
5. key = start + offset(partition) + position. One partition needs no offsets:
   its positions are the keys.

Only the sum and the largest of the counts reach the driver. The sum is the
exact row count, returned so callers can size-check a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import cut_lineage

_PART = "_k1_part"
_POS = "_k1_pos"
_POS_LIMIT = 1 << 33  # monotonically_increasing_id numbers 2^33 rows per partition
MAX_BROADCAST_PARTS = 200_000


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


@dataclass
class Keyed:
    """A keyed frame and its exact row count (a proven size for broadcasts)."""

    df: DataFrame
    rows: int


def dense_keys(
    df: DataFrame,
    order_by: Sequence[str | Column],
    key_col: str,
    start: int = 1,
    partitions: int | None = None,
    keep: Sequence[str] | None = None,
) -> Keyed:
    """Append ``key_col`` = start, start+1, ... in ``order_by`` order.

    ``order_by`` should be unique for a reproducible numbering; ties are
    numbered in an arbitrary but dense way. The result is materialised.
    ``partitions`` fixes the range partition count (pass it when the row count
    is known; one partition needs no sampling pass); by default AQE sizes it.
    ``keep`` names the columns that stay beside the key, by default all: the others
    go no further than the ordering needs them.
    """
    kept = list(keep if keep is not None else df.columns)
    if partitions == 1:
        keyed = _one_partition(df, order_by, key_col, start, kept)
        return Keyed(keyed, keyed.count())  # of a written table: read from its footers
    order_cols = _cols(order_by)
    pid = F.spark_partition_id().cast("long")
    # Without an explicit count, AQE sizes the range shuffle from measured
    # bytes; it only merges *adjacent* ranges, so partition order stays key
    # order.
    ranged = df.repartitionByRange(partitions, *order_cols) if partitions else df.repartitionByRange(*order_cols)
    tagged = (
        ranged.sortWithinPartitions(*order_cols)
        .select(
            *[F.col(c) for c in kept],
            pid.alias(_PART),
            (F.monotonically_increasing_id() - F.shiftleft(pid, 33)).alias(_POS),
        )
    )
    tagged = cut_lineage(tagged, "dense-keys", compression="zstd")

    # one row per range partition; its running start stays a small table, so
    # nothing per partition passes through the driver or the query's text
    counts = tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows"))
    total, most, parts = counts.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0)), F.count(F.lit(1))
    ).first()
    if most >= _POS_LIMIT:
        raise ValueError(
            f"a range partition holds {most} rows; positions allow {_POS_LIMIT} - pass more partitions"
        )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    placed = tagged.join(F.broadcast(offsets) if parts <= MAX_BROADCAST_PARTS else offsets, _PART)
    key = (F.lit(int(start)) + F.col("_offset") + F.col(_POS)).cast("long").alias(key_col)
    return Keyed(placed.select(key, *[F.col(c) for c in kept]), int(total))


def _one_partition(
    df: DataFrame, order_by: Sequence[str | Column], key_col: str, start: int, kept: Sequence[str]
) -> DataFrame:
    """Keys of a frame that its caller knows to fit one task; materialised."""
    order_cols = _cols(order_by)
    key = (F.lit(int(start)) + F.monotonically_increasing_id()).cast("long").alias(key_col)
    ordered = df.repartitionByRange(1, *order_cols).sortWithinPartitions(*order_cols)
    return cut_lineage(ordered.select(key, *[F.col(c) for c in kept]), "dense-keys", compression="zstd")


def assign_dense_keys(
    df: DataFrame,
    order_by: Sequence[str | Column],
    key_col: str,
    start: int = 1,
    partitions: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """:func:`dense_keys` without the row count."""
    if partitions == 1:
        return _one_partition(df, order_by, key_col, start, list(keep if keep is not None else df.columns))
    return dense_keys(df, order_by, key_col, start, partitions, keep).df


def next_key(df: DataFrame | None, key_col: str) -> int:
    """``max(key) + 1`` of an existing table (1 for an empty or missing one)."""
    if df is None:
        return 1
    top = df.agg(F.max(key_col).alias("m")).first()["m"]
    return 1 if top is None else int(top) + 1
