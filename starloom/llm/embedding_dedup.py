"""Near-duplicate embeddings by random-hyperplane signs.

1. Equal vectors form one class; only one vector of a class is compared.
2. A vector's signs against ``bits`` random hyperplanes name its bucket in a
   table. Two vectors at an angle w agree in one sign with probability 1 - w/pi.
   Buckets grow narrower with the number of classes (about four buckets a class),
   and there are as many tables as make all of them miss a pair at the threshold
   with a probability below ``MISS``; closer pairs are missed far more rarely.
3. Buckets with one member are left out. A bucket of more than ``CELL`` members
   is dealt into parts, and each pair of parts is a cell of its own, so no task
   has to hold a whole bucket.
4. In a cell all cosines are computed exactly, as blocks of matrix products. A
   pair is counted in the first table in which it meets, so once. What leaves the
   cell is a row a vector: its number of links there and its root in a spanning
   forest of the cell's links; pairs are never written.
5. The forests' edges give the connected components.

Signs are taken of sums of whole numbers that fit a double exactly, so every task
finds the same buckets for a vector.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from starloom.llm.components import components
from starloom.llm.vectors import finite_vectors, stacked
from starloom.session import cut_lineage

MISS = 1e-6
CELL = 2048
BLOCK = 1024
#: Groups up to this size are compared together, row against following row.
SMALL = 48
MAX_BITS, MAX_TABLES = 30, 1023
PAIRS_AT_ONCE = 1 << 15


def tables_for(classes: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for so many different vectors."""
    bits = min(MAX_BITS, max(4, math.ceil(math.log2(max(classes, 1))) + 2))
    agree = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    if agree**bits >= 1 - 1e-12:
        return bits, 1
    return bits, min(MAX_TABLES, math.ceil(math.log(miss) / math.log1p(-(agree**bits))))


@lru_cache(maxsize=4)
def _planes(dim: int, count: int) -> np.ndarray:
    return np.rint(np.random.default_rng([dim, 77]).standard_normal((dim, count)) * 1024)


def buckets_of(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Each row's bucket in each table: (dimension, table, signs) as one number."""
    dim = x.shape[1]
    whole = np.rint(x / np.abs(x).max(axis=1, keepdims=True) * (1 << 20))
    signs = (whole @ _planes(dim, bits * tables) >= 0).reshape(len(x), tables, bits)
    codes = signs @ (1 << np.arange(bits, dtype=np.int64))
    return codes + (np.arange(tables, dtype=np.int64) << 30) + (dim << 40)


def _profiles(kind: str):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts, lengths = finite_vectors(batch.column("v"))
            keys, vectors = [], []
            for at, n in zip(starts, lengths, strict=True):
                x = flat[at : at + max(n, 0)] + 0.0  # one zero, not two
                if n <= 0 or not x.any():
                    keys.append(None), vectors.append(None)
                    continue
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                vectors.append(x.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())],
                names=["id", "key", "vec"],
            )

    return profile


def _by_length(blobs: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each vector length."""
    sizes = np.array([len(x) for x in blobs.to_pylist()], np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, stacked(blobs.take(pa.array(rows)), kind).astype(np.float64)


def _placed(bits: int, tables: int, kind: str):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                for rows, x in _by_length(some.column("vec"), kind):
                    keys = some.column("key").take(pa.array(np.repeat(rows, tables)))
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(buckets_of(x, bits, tables).ravel())], names=["key", "bucket"]
                    )

    return place


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows reaches over the pairs (i, j)."""
    root = np.arange(n)
    while True:
        before, least = root.copy(), np.minimum(root[i], root[j])
        for side in (i, j, before[i], before[j]):
            np.minimum.at(root, side, least)
        root = root[root]
        if (root == before).all():
            return root


class _Cells:
    """Links of the complete cells in a run of rows sorted by cell."""

    def __init__(self, bits: int, tables: int, threshold: float):
        self.shape, self.threshold = (bits, tables), threshold

    def first_met(self, x: np.ndarray, bucket: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs meet in no earlier table than this one."""
        rows, back = np.unique(np.concatenate([i, j]), return_inverse=True)
        met = buckets_of(x[rows], *self.shape)
        out = np.empty(len(i), bool)
        for at in range(0, len(i), PAIRS_AT_ONCE):
            a, b = (met[back[k + at : k + min(at + PAIRS_AT_ONCE, len(i))]] for k in (0, len(i)))
            first = (a == b).argmax(axis=1)
            out[at : at + PAIRS_AT_ONCE] = a[np.arange(len(a)), first] == bucket[i[at : at + PAIRS_AT_ONCE]]
        return out

    def close_pairs(self, unit: np.ndarray, group: np.ndarray, seat: np.ndarray, crossed: np.ndarray):
        """Blocks (i, j) of the pairs of a cell at the threshold or above."""
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[starts, len(group)])
        small = np.repeat((sizes <= SMALL) & ~crossed[starts], sizes)
        for step in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
            i = np.flatnonzero((group[:-step] == group[step:]) & small[:-step])
            i = i[np.einsum("ij,ij->i", unit[i], unit[i + step]) >= self.threshold]
            if len(i):
                yield i, i + step
        for at, size in zip(starts, sizes, strict=True):
            if small[at]:
                continue
            rows = np.arange(at, at + size)
            # a cell of two parts compares the one with the other only
            left, right = (rows[seat[rows] == s] for s in (0, 1)) if crossed[at] else (rows, rows)
            for p in range(0, len(left), BLOCK):
                for q in range(0 if crossed[at] else p, len(right), BLOCK):
                    a, b = left[p : p + BLOCK], right[q : q + BLOCK]
                    i, j = np.nonzero(unit[a] @ unit[b].T >= self.threshold)
                    i, j = a[i], b[j]
                    if not crossed[at]:
                        i, j = i[i < j], j[i < j]
                    if len(i):
                        yield i, j

    def links(self, x, group, bucket, seat, crossed, copies) -> tuple[np.ndarray, np.ndarray]:
        """Per row: the number of vectors it links with, and its root row."""
        scaled = x / np.abs(x).max(axis=1, keepdims=True)
        unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
        n, ends = np.zeros(len(x), np.int64), [np.empty((2, 0), np.int64)]
        for i, j in self.close_pairs(unit, group, seat, crossed):
            new = self.first_met(x, bucket, i, j)
            i, j = i[new], j[new]
            np.add.at(n, i, copies[j])
            np.add.at(n, j, copies[i])
            rows, back = np.unique(np.concatenate([i, j]), return_inverse=True)
            root = rows[_roots(len(rows), back[: len(i)], back[len(i) :])]
            ends.append(np.stack([rows, root]))
        i, j = np.concatenate(ends, axis=1)
        return n, _roots(len(x), i, j)


def _linked(bits: int, tables: int, threshold: float, kind: str):
    cells = _Cells(bits, tables, threshold)

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        lo, hi, bucket, seat, copies = (
            table.column(c).to_numpy() for c in ("lo", "hi", "bucket", "seat", "copies")
        )
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
        group, blobs = np.cumsum(new), table.column("vec").combine_chunks()
        for rows, x in _by_length(blobs, kind):  # a cell's vectors have one length
            n, root = cells.links(
                x, group[rows], bucket[rows], (seat != lo)[rows].astype(int), (lo != hi)[rows], copies[rows]
            )
            own = np.flatnonzero(n)
            ids = table.column("id").to_numpy()[rows]
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("key").combine_chunks().take(pa.array(rows[own])),
                    pa.array(ids[own]),
                    pa.array(ids[root[own]]),
                    pa.array(n[own]),
                ],
                names=["key", "id", "root", "n"],
            )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = [batch.column(c).to_numpy() for c in ("bucket", "lo", "hi")]
            last = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in cell]))
            cut = int(last[-1]) + 1 if len(last) else 0
            begins = not held or all(held[-1].column(c)[-1] == batch.column(c)[0] for c in ("bucket", "lo", "hi"))
            if held and not begins:
                yield from solve(pa.Table.from_batches(held))
                held = []
            if cut:
                yield from solve(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from solve(pa.Table.from_batches(held))

    return link


def embedding_near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.95,
    miss: float = MISS,
    cell: int = CELL,
) -> DataFrame:
    """``id``, ``n_links``, ``component_id``, ``kept``: one row per input row.

    Rows whose vectors have a cosine of ``threshold`` (above 0) or more are linked;
    ``n_links`` counts the other rows that a row links with directly, equal vectors
    included. ``component_id`` is the smallest id reachable, ``kept`` says that it
    is the row's own. A vector that is null, empty or zero, or holds null or
    non-finite entries, links with nothing, and so do vectors of different
    lengths. Rows of one id share a component. A row with a null id links with
    nothing: its component is null and it is kept. An empty table gives an empty
    result; other columns are not read.
    """
    kind = "<f4" if isinstance(vectors.schema[vec_col].dataType.elementType, FloatType) else "<f8"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    profiles = cut_lineage(rows.mapInArrow(_profiles(kind), "id bigint, key binary, vec binary"), "vectors")
    usable = F.col("id").isNotNull() & F.col("key").isNotNull()
    named = profiles.filter(usable)
    classes = cut_lineage(
        named.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")),
        "vector-classes",
    )
    bits, tables = tables_for(classes.count(), threshold, miss)
    met = cut_lineage(
        classes.select("key", "vec").mapInArrow(_placed(bits, tables, kind), "key binary, bucket bigint"), "sign-buckets"
    )
    shared = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = shared.select("bucket", F.ceil(F.col("n") / F.lit(cell)).cast("int").alias("parts"))
    seats = met.join(shared, "bucket").withColumn("seat", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    seats = seats.join(classes, "key")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    cells = seats.select("key", "id", "copies", "vec", "bucket", "seat", other).withColumns(
        {"lo": F.least("seat", "other"), "hi": F.greatest("seat", "other")}
    )
    sorted_cells = (
        cells.drop("other").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "seat")
    )
    links = cut_lineage(
        sorted_cells.mapInArrow(
            _linked(bits, tables, threshold, kind), "key binary, id bigint, root bigint, n bigint"
        ),
        "vector-links",
    )
    # an id with several vectors ties their classes together
    several = named.groupBy("id").agg(F.min("key").alias("p"), F.max("key").alias("q")).filter("p <> q").select("id")
    ties = (
        named.join(several, "id", "left_semi")
        .select(F.col("id").alias("a"), "key")
        .join(classes.select("key", F.col("id").alias("b")), "key")
        .select("a", "b")
    )
    roots = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(ties))
    counts = links.groupBy("key").agg(F.sum("n").alias("n"))
    told = (
        classes.select("key", "id", "copies")
        .join(counts, "key", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        )
    )
    linked = named.select("id", "key").join(told, "key").select("id", "n_links", "component_id")
    # a tie may lead an id with unusable vectors only to itself
    alone = profiles.filter(~usable).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept")
    return linked.unionByName(alone).select("id", "n_links", "component_id", kept)


def op13_query(spark: SparkSession, root: str) -> DataFrame:
    vectors = spark.read.parquet(f"{root}/embeddings.parquet").select("vec_id", "embedding")
    return embedding_near_duplicates(vectors).withColumnRenamed("id", "vec_id")


OP13_SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
    and len(list_filter(embedding, lambda c: c <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
), least_of as (
  select a, min(b) as m from reach group by a
), counted as (
  select a, count(*) as n from links group by a
)
select e.vec_id, coalesce(n, 0) as n_links, least(e.vec_id, coalesce(m, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) as kept
from embeddings e left join counted c on c.a = e.vec_id left join least_of l on l.a = e.vec_id
"""
