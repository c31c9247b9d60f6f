"""Token output in training order: fixed-stride binary shards.

Every text becomes sequences of ``seq_len`` 16-bit ids, padded to one stride.
The sequences are numbered along the input's partitions; a keyed Feistel
permutation of [0, N) turns a number into the sequence's slot. The Feistel
network works on the next even number of bits and walks on along its cycle
until it lands below N, so no slot is left out or used twice and no table of
the order is kept anywhere. Slots are dealt to shards by range, one task
writes one shard, held whole as its size is fixed, and slot s lies at a known
byte of a known file: a reader can start, stop and resume anywhere.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.tokens import TOKENIZER, TextIds
from starloom.session import cut_lineage, scratch_path

SEQ_LEN = 512
END_ID = 49407
PAD_ID = 0
SHARD_SEQUENCES = 1 << 14
ROUNDS = 6
KEY = 20260101
#: Zstandard levels of the shuffled ids, and of the kept ones with their Parquet pages.
SHUFFLE_LEVEL = 4
KEPT = {"compression": "zstd", "parquet.compression.codec.zstd.level": 5, "parquet.page.size": 8 << 20}
INDEX = ["id", "piece", "slot", "shard", "length", "byte_offset", "ids_crc32"]


def _mix(x: np.ndarray, key: int, turn: int) -> np.ndarray:
    salt = (key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    x = (x + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slot of every index below ``n``: a permutation of [0, n)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> bits, out[walking] & mask
        for turn in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key, turn) & mask)
        out[walking] = (left << bits) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def _tokenized(tokenizer: str, end_id: int, seq_len: int):
    """Every text's ids with the end id, numbered inside its task."""

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, first = TextIds.shared(tokenizer, "<u2"), np.array([end_id], "<u2").tobytes(), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                ids = [x + end for x in ids_of.of(t.as_py() for t in some.column("text"))]
                many = np.array([-(-len(x) // (2 * seq_len)) for x in ids], np.int64)
                starts = first + np.cumsum(many) - many
                first += int(many.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(starts),
                        pa.array(many),
                        some.column("id"),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["part", "first", "n", "id", "ids"],
                )

    return tokenized


def _deal(starts, n: int, seq_len: int, per_shard: int, key: int):
    """Sequences with their slots, one row a shard and batch; ids stay unpadded until they are written."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, pack = 2 * seq_len, zstandard.ZstdCompressor(level=SHUFFLE_LEVEL)
        for batch in batches:
            many = batch.column("n").to_numpy()
            row = np.repeat(np.arange(len(many)), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            base = np.array([starts.value[p] for p in batch.column("part").to_pylist()], np.int64)
            slot = permute((base + batch.column("first").to_numpy())[row] + piece, n, key)
            order = np.argsort(slot // per_shard, kind="stable")
            row, piece, slot = row[order], piece[order], slot[order]
            texts = batch.column("ids").to_pylist()
            ids = [texts[r][p * step : (p + 1) * step] for r, p in zip(row.tolist(), piece.tolist(), strict=True)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
            shards, first = np.unique(slot // per_shard, return_index=True)
            bounds = [*first.tolist(), len(ids)]
            offsets = pa.array(bounds, pa.int32())
            columns = [batch.column("id").take(pa.array(row)), piece.astype(np.int32), slot, lengths.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards.astype(np.int32)),
                    *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in columns),
                    pa.array([pack.compress(b"".join(ids[i:j])) for i, j in pairwise(bounds)], pa.binary()),
                ],
                names=["shard", "id", "piece", "slot", "length", "packed"],
            )

    return deal


def _local(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder's address; plain paths are local."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _write(path: str, n: int, per_shard: int, stride: int, pad_id: int):
    """Writes the shards that come to the task; a shard's size is fixed, so one is held whole."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _local(path)
        attempt = TaskContext.get().taskAttemptId()
        pad, unpack = np.array([pad_id], "<u2").tobytes(), zstandard.ZstdDecompressor()
        held: dict[int, tuple[bytearray, list[pa.Table]]] = {}
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                if shard not in held:
                    size = min(per_shard, n - shard * per_shard)
                    held[shard] = bytearray(pad * (size * stride // 2)), []
                buffer, parts = held[shard]
                rows = {c: batch.column(c)[i].values for c in ("id", "piece", "slot", "length")}
                parts.append(pa.table(rows))
                ids, start = unpack.decompress(batch.column("packed")[i].as_py()), 0
                at = (rows["slot"].to_numpy() - shard * per_shard) * stride
                for place, length in zip(at.tolist(), (rows["length"].to_numpy() * 2).tolist(), strict=True):
                    buffer[place : place + length] = ids[start : start + length]
                    start += length
        for shard, (buffer, parts) in held.items():
            index = pa.concat_tables(parts).sort_by("slot").combine_chunks()
            slots = index.column("slot").to_numpy()
            first = shard * per_shard
            if not np.array_equal(slots, np.arange(first, first + len(buffer) // stride)):
                raise RuntimeError(f"slots of shard {shard} are missing or come twice")
            name = f"{base}/shard-{shard:07d}.bin"
            with store.open_output_stream(f"{name}.{attempt}.part") as out:
                out.write(buffer)
            store.move(f"{name}.{attempt}.part", name)  # a retry replaces the whole shard
            place, view = (slots - first) * stride, memoryview(buffer)
            index = (
                index.append_column("shard", pa.array(np.full(len(slots), shard, np.int32)))
                .append_column("byte_offset", pa.array(place))
                .append_column("ids_crc32", pa.array([zlib.crc32(view[x : x + stride]) for x in place.tolist()], pa.int64()))
            )
            yield from index.select(INDEX).to_batches()

    return write


def write_training_order(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_len: int = SEQ_LEN,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    pad_id: int = PAD_ID,
    shard_sequences: int = SHARD_SEQUENCES,
    key: int = KEY,
) -> DataFrame:
    """Writes the shards under ``path`` and returns their index, one row per
    sequence: ``id``, ``piece``, ``length``, ``slot``, ``shard``, ``byte_offset``, ``ids_crc32``.

    ``path`` has to be a folder that all executors share. ``length`` counts ids
    without padding; ``ids_crc32`` is of the padded 16-bit little-endian ids. A null
    or empty text is one sequence with the end id alone; null ids are carried
    along; equal rows are separate documents. An empty table gives a manifest, no
    shard and an empty index. Other columns are not read. The ids are kept, with
    their numbers along the input's partitions, in a table below the checkpoint folder.
    The same table, partitioning and key give the same shards. The manifest is
    written last, so it never names a shard that does not stand; shards that a
    longer earlier run left in ``path`` are removed.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    # tokenized once; the numbers along the partitions are written with the ids
    path_of_ids, kind = scratch_path(spark, "token-ids"), "part int, first bigint, n bigint, id bigint, ids binary"
    texts.mapInArrow(_tokenized(tokenizer, end_id, seq_len), kind).write.options(**KEPT).parquet(path_of_ids)
    tokens = spark.read.schema(kind).parquet(path_of_ids)
    # one small row for each of the input's partitions
    counts = {r["part"]: r["n"] for r in tokens.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    starts, n = {}, 0
    for part in sorted(counts):
        starts[part] = n
        n += counts[part]
    shards, stride = -(-n // shard_sequences), 2 * seq_len
    store, base = _local(path)
    store.create_dir(base, recursive=True)
    # no manifest stands while shards are written, and no shard of a longer run stays
    old = store.get_file_info(fs.FileSelector(base))
    for info in old:
        if info.base_name == "manifest.json":
            store.delete_file(info.path)
    dealt = tokens.mapInArrow(
        _deal(spark.sparkContext.broadcast(starts), n, seq_len, shard_sequences, key),
        "shard int, id array<bigint>, piece array<int>, slot array<bigint>, length array<int>, packed binary",
    )
    # the shard's number is its partition's number: no sampling, one shard a task
    ranged = dealt.repartitionById(max(1, shards), F.col("shard"))
    written = ranged.mapInArrow(
        _write(path, n, shard_sequences, stride, pad_id),
        "id bigint, piece int, slot bigint, shard int, length int, byte_offset bigint, ids_crc32 bigint",
    )
    index = cut_lineage(written, "training-order")
    for info in old:
        name = info.base_name
        if name.startswith("shard-") and (not name[6:13].isdigit() or int(name[6:13]) >= shards or name.endswith(".part")):
            store.delete_file(info.path)
    manifest = {"sequences": n, "seq_len": seq_len, "stride": stride, "shard_sequences": shard_sequences, "shards": shards}
    with store.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps(manifest | {"dtype": "<u2", "key": key, "pad_id": pad_id, "end_id": end_id}).encode())
    return index.select("id", "piece", "length", "slot", "shard", "byte_offset", "ids_crc32")


def read_sequences(path: str, start: int, count: int) -> np.ndarray:
    """Slots ``start`` to ``start + count - 1`` as rows of ids, read by their place alone."""
    store, base = _local(path)
    with store.open_input_stream(f"{base}/manifest.json") as f:
        m = json.loads(f.read())
    stop, parts = min(start + count, m["sequences"]), []
    while start < stop:
        shard, row = divmod(start, m["shard_sequences"])
        take = min(stop - start, m["shard_sequences"] - row)
        with store.open_input_file(f"{base}/shard-{shard:07d}.bin") as f:
            f.seek(row * m["stride"])
            parts.append(np.frombuffer(f.read(take * m["stride"]), m["dtype"]))
        start += take
    return np.concatenate(parts or [np.empty(0, "<u2")]).reshape(-1, m["seq_len"])


def op8_query(spark: SparkSession, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    return write_training_order(docs, scratch_path(spark, "shards")).withColumnRenamed("id", "doc_id")
