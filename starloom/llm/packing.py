"""Best-fit packing of documents into token sequences, by exact complements.

Documents are cut into pieces of at most ``capacity`` tokens. Only the number of
pieces of each length matters for the plan, a table of at most ``capacity``
rows at any size of the data. The plan starts a sequence with the longest piece
left and fills its gap from an index of the lengths present, the sums of two,
and the sums of three: a single piece, a pair or a triple that fits exactly.
Where none does, the longest piece that fits goes in, and the smaller gap is
tried again. A found pattern is used as often as the pieces last, so the
plan has few rows. Spark numbers the pieces of each length and looks their
sequence up in the plan, which is broadcast: its size has a fixed bound.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.tokens import TOKENIZER, TextIds
from starloom.session import cut_lineage

CAPACITY = 2048
END_ID = 0
PLAN = "length int, first_rank bigint, end_rank bigint, per_sequence bigint, first_sequence bigint, at int"


class _Lengths:
    """Available lengths with an index of their single and pair sums."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        self.present = self.left > 0
        self.present[0] = False
        n = len(counts)
        self.pairs = np.zeros(2 * n, np.int64)  # ordered pairs of present lengths, by sum
        for x in np.flatnonzero(self.present):
            self.pairs[x : x + n] += self.present

    def use(self, length: int, count: int) -> None:
        self.left[length] -= count
        if not self.left[length] and self.present[length]:
            n = len(self.left)
            self.pairs[length : length + n] -= 2 * self.present
            self.pairs[2 * length] += 1  # (x, x) was one ordered pair
            self.present[length] = False

    def enough(self, items: Counter) -> bool:
        return all(self.left[x] >= c for x, c in items.items())

    def exact(self, gap: int, items: Counter) -> list[int] | None:
        """One, two or three lengths that fill the gap exactly, long ones first."""
        if self.present[gap] and self.enough(items + Counter([gap])):
            return [gap]
        if found := self._pair(gap, items):
            return found
        firsts = np.flatnonzero(self.present[: gap - 1])[::-1]
        for a in firsts[self.pairs[gap - firsts] > 0]:
            if 3 * a < gap:
                break
            if found := self._pair(gap - int(a), items + Counter([int(a)])):
                return [int(a), *found]
        return None

    def _pair(self, gap: int, items: Counter) -> list[int] | None:
        if not self.pairs[gap]:
            return None
        both = self.present[1:gap] & self.present[gap - 1 : 0 : -1]
        for a in np.flatnonzero(both)[::-1] + 1:
            if 2 * a < gap:
                break
            pair = [int(a), gap - int(a)]
            if self.enough(items + Counter(pair)):
                return pair
        return None

    def longest(self, room: int, items: Counter) -> int | None:
        for x in np.flatnonzero(self.present[: room + 1])[::-1]:
            if self.left[x] > items[int(x)]:
                return int(x)
        return None


def plan_patterns(counts: np.ndarray, capacity: int) -> list[tuple[Counter, int]]:
    """Patterns of lengths, and how often each is used, that place every piece.
    ``counts[n]`` is the number of pieces of length n."""
    lengths, plan = _Lengths(np.asarray(counts)), []
    nothing: Counter = Counter()
    while (first := lengths.longest(capacity, nothing)) is not None:
        items = Counter([first])
        gap = capacity - first
        while gap:
            if found := lengths.exact(gap, items):
                items.update(found)
                break
            fit = lengths.longest(gap, items)
            if fit is None:
                break
            items[fit] += 1
            gap -= fit
        times = min(int(lengths.left[x]) // c for x, c in items.items())
        for x, c in items.items():
            lengths.use(x, c * times)
        plan.append((items, times))
    return plan


def plan_rows(patterns: list[tuple[Counter, int]]) -> list[tuple[int, int, int, int, int, int]]:
    rows, used, sequence = [], Counter(), 0
    for items, times in patterns:
        at = 0
        for length, per in sorted(items.items(), reverse=True):
            rows.append((length, used[length], used[length] + per * times, per, sequence, at))
            used[length] += per * times
            at += per * length
        sequence += times
    return rows


def _cut(capacity: int, tokenizer: str, end_id: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TextIds.shared(tokenizer, stage=TaskContext.get().stageId())
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, ids in enumerate(ids_of.of(t.as_py() for t in batch.column("text"))):
                ids += end
                for i, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append(row), piece.append(i), start.append(at // 4)
                    length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part)
            columns = {
                "id": batch.column("id").take(pa.array(rows, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int32()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return cut


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` (and ``ids``, little-endian 32 bits, if kept).

    A document is its text's ids and one end id; null or empty text is the end
    id alone. Only documents longer than ``capacity`` are cut. Pieces of a
    sequence follow one another without gaps. Ids of any integer, null included,
    are carried along; equal rows are separate documents with places of their
    own. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id bigint, piece int, start bigint, length int, ids_crc32 bigint" + ", ids binary" * keep_ids
    pieces = cut_lineage(texts.mapInArrow(_cut(capacity, tokenizer, end_id, keep_ids), schema), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    # one row per length: at most ``capacity`` rows
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    plan = spark.createDataFrame(plan_rows(plan_patterns(counts, capacity)), PLAN)

    # number the pieces of a length: in 4096 cells each, then over the cells
    celled = pieces.withColumn("cell", F.pmod(F.xxhash64("id", "start"), F.lit(4096)).cast("int"))
    cells = celled.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("length", "cell", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    in_cell = Window.partitionBy("length", "cell").orderBy("id", "start", "ids_crc32")
    ranked = celled.withColumn("in_cell", F.row_number().over(in_cell)).join(starts, ["length", "cell"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("in_cell") - 1)
    placed = ranked.join(F.broadcast(plan), "length").filter("rank >= first_rank and rank < end_rank")
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        "id",
        "piece",
        "start",
        F.col("length").cast("bigint").alias("length"),
        "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("at") + (nth % F.col("per_sequence")) * F.col("length")).cast("bigint").alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def op3_query(spark: SparkSession, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs).withColumnRenamed("id", "doc_id")
