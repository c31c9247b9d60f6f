"""Language-model scores: a hashed maximum-entropy model with classes.

P(word | context) = P(class | context) * P(member | class, context) * P(word | class, member).
Classes come from the word alone: the most frequent words have one each, other words
share a class by a hash of their last two bytes, which tells languages and endings
apart, and are a member of it by a hash of the whole word. The first two factors are
softmaxes, over the classes and over the members of the word's class. Their scores add
up a weight row for each feature of the context: the word before, the word before that
(a skip), the two together, and the classes one and three words before; for members,
each together with the class. Features are hashed to rows, whose number grows with the
training tokens. P(word | class, member) is the word's smoothed count.

Training: every training token is used once, in rounds over disjoint parts of the
documents. A round is one gradient step: for each weight, how often its output followed
its feature, less how often the round's common model expects it to. The expectation is
drawn, once a token, from the model's own distribution by a hash of the context, so
both sides are whole numbers. Spark adds them up in blocks of weight rows, and the step
is the sum over its curvature: the partitions change nothing but last digits. A model of up to
2 ** HELD_BITS rows is sent to the tasks; of a larger one each round writes files of rows, of
which an executor's machine maps a copy, and a task keeps about KEPT outcomes at most. Counts are exact,
over all training tokens. Words above a fixed share of all tokens (so a bounded
number) are sent to all tasks with their counts; the other words of
each document are joined with the counts.
"""

from __future__ import annotations

import fcntl
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import Broadcast, SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import cut_lineage, scratch_path

OWN_CLASSES = 16
SHARED_CLASSES = 16
CLASSES = OWN_CLASSES + SHARED_CLASSES
MEMBERS = 16
OUTPUTS = CLASSES + MEMBERS  # weights in a row: of the classes, of a class's members
LEAVES = OWN_CLASSES + SHARED_CLASSES * MEMBERS
#: Weight rows: a power of two, one for so many training tokens.
TOKENS_PER_ROW = 1024
MIN_ROW_BITS = 14
#: Up to so many rows, each task holds the weights and a count of every output (150 MB).
HELD_BITS = 18
#: Above: rows in a file, and outcomes that a task keeps before it counts them and gives the counts away.
FILE_BITS, KEPT = 14, 1 << 22
#: Spark deletes a query's shuffles when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FEATURES = 4
MINIBATCH = 2048
#: A step is RATE * 2 * (seen - expected) / (seen + expected + 2 * PRIOR).
RATE, PRIOR = 0.4, 6.0
#: Shares of the training documents in the rounds, by a hash of the id.
ROUNDS = (0.4, 0.3, 0.3)
#: A word with at least 1 / FREQUENT of all tokens is frequent: at most this many.
FREQUENT = 150_000
REMEMBERED = 1 << 20
CHUNK_BYTES = 1 << 21
BLOCK_ROWS = 64
END = b""  # no word is empty


def words_of(text: str | None) -> list[bytes]:
    """Lower-cases A-Z, splits at ASCII white space, adds the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def split_texts(texts: pa.Array) -> pa.ListArray:
    """:func:`words_of` each text. What follows a last space is the end."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    with_end = pc.binary_join_element_wise(texts, "", " ")
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, with_end))


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1


@dataclass
class Lexicon:
    """What all tasks share: the frequent words' classes and counts, leaf masses.

    A leaf is a class with one word, or one member of a shared class."""

    own: dict[bytes, int]
    frequent: dict[bytes, int]
    mass: np.ndarray

    def class_bias(self) -> np.ndarray:
        shared = self.mass[OWN_CLASSES:].reshape(SHARED_CLASSES, MEMBERS).sum(axis=1)
        return np.log(np.r_[self.mass[:OWN_CLASSES], shared]).astype(np.float32)

    def member_bias(self) -> np.ndarray:
        """One row a shared class."""
        return np.log(self.mass[OWN_CLASSES:].reshape(SHARED_CLASSES, MEMBERS)).astype(np.float32)


def leaves_of(words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """Leaves in the shared classes: the class by the last two bytes, the member by the hash."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + 2
    text = np.frombuffer(b"\0\0" + b"".join(words), np.uint8).astype(np.uint32)
    tail = text[ends - 1] * np.uint32(256) + text[ends - 2]
    cls = (tail * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64) % SHARED_CLASSES
    return OWN_CLASSES + cls * MEMBERS + (hashes >> np.uint64(20)).astype(np.int64) % MEMBERS


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def class_of(leaf: np.ndarray) -> np.ndarray:
    return np.where(leaf < OWN_CLASSES, leaf, OWN_CLASSES + (leaf - OWN_CLASSES) // MEMBERS)


@dataclass
class _Seen:
    """Arrays of different words' hashes, leaves and log counts (nan: not frequent)."""

    hash: np.ndarray
    leaf: np.ndarray
    log_count: np.ndarray


class _Lookup:
    """Looks words up in a lexicon; the leaves of its frequent words are found once."""

    def __init__(self, lexicon: Lexicon):
        common = list(lexicon.frequent)
        self.own, self.frequent = (pa.array(list(x), pa.binary()) for x in (lexicon.own, common))
        self.own_leaf = np.array([*lexicon.own.values(), -1])
        self.leaf = np.r_[leaves_of(common, hashes_of(common)), -1]
        self.log_count = np.r_[np.log10(np.fromiter(lexicon.frequent.values(), np.float64) + 0.5), np.nan]

    def of(self, words: pa.Array) -> _Seen:
        some, at = _bytes_of(words), _index(words, self.frequent)
        hashes, leaf, own = hashes_of(some), self.leaf[at], self.own_leaf[_index(words, self.own)]
        leaf = np.where(leaf < 0, leaves_of(some, hashes), leaf)
        return _Seen(hashes, np.where(own < 0, leaf, own), self.log_count[at])


def _index(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Places of words among others, -1 for those that are not there."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy(zero_copy_only=False)


def _bytes_of(words: pa.Array) -> list[bytes]:
    _, ends, text = words.buffers()
    ends = np.frombuffer(ends, np.int32, len(words) + 1, 4 * words.offset).tolist()
    text = text.to_pybytes() if text else b""
    return [text[at:end] for at, end in pairwise(ends)]


class _Docs:
    """Some texts: their different words, the place of every token's word there, lengths."""

    def __init__(self, texts: pa.Array):
        found = split_texts(texts)
        tokens = found.flatten().cast(pa.binary()).dictionary_encode()
        self.words, self.places = tokens.dictionary, tokens.indices.to_numpy().astype(np.int64)
        self.lengths = np.diff(found.offsets.to_numpy()).astype(np.int64)

    def __len__(self) -> int:
        return len(self.lengths)

    def __iter__(self) -> Iterator[list[bytes]]:
        words = _bytes_of(self.words)
        for at, n in zip(_starts(self), self.lengths, strict=True):
            yield [words[i] for i in self.places[at : at + n]]

    def counts(self, chosen: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
        """Each text's different words among the chosen tokens, and how often they come."""
        doc = np.repeat(np.arange(len(self)), self.lengths)[chosen]
        pairs, times = np.unique(doc * len(self.words) + self.places[chosen], return_counts=True)
        doc, word = np.divmod(pairs, max(1, len(self.words)))
        ends = pa.array(np.searchsorted(doc, np.arange(len(self) + 1)), pa.int32())
        return (
            pa.ListArray.from_arrays(ends, self.words.take(pa.array(word))),
            pa.ListArray.from_arrays(ends, pa.array(times, pa.int64())),
        )


def _slices_of(texts: pa.Array) -> list[tuple[int, int]]:
    """Bounds of slices that start within CHUNK_BYTES of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    chunk = np.r_[0, ends[:-1]] // CHUNK_BYTES
    return list(pairwise([0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(texts)])) if len(texts) else []


def _chunks(batches: Iterator[pa.RecordBatch], lexicon: Lexicon):
    """(batch, its rows, their words, places of all words, what is seen) in bounded chunks."""
    lookup = _Lookup(lexicon)
    for batch in batches:
        texts = batch.column("text")
        for at, end in _slices_of(texts):
            docs = _Docs(texts.slice(at, end - at))
            yield batch, range(at, end), docs, docs.places, lookup.of(docs.words)


def _features(places: np.ndarray, starts: np.ndarray, seen: _Seen) -> np.ndarray:
    """Hashes of every token's context, one row a feature; words before a text count as one mark."""
    n = len(places)
    h, c = seen.hash[places], class_of(seen.leaf[places]).astype(np.uint64)
    depth = _depth(n, starts)

    def before(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        out[k:] = x[: n - k]
        out[depth < k] = np.uint64(0x5BD1E995)
        return out

    h1, h2, c1, c3 = before(h, 1), before(h, 2), before(c, 1), before(c, 3)
    pair = h1 * np.uint64(0x9E3779B97F4A7C15) ^ (h2 * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(3))
    skips = (c1 * np.uint64(64) + c3 + np.uint64(11)) * np.uint64(0x9E3779B97F4A7C15)
    return np.stack([h1 * np.uint64(0xBF58476D1CE4E5B9), h2 * np.uint64(0x94D049BB133111EB), pair, skips])


def _depth(n: int, starts: np.ndarray) -> np.ndarray:
    """Words of each token's text before it."""
    first = np.zeros(n, np.int64)
    first[starts] = 1
    return np.arange(n) - starts[np.cumsum(first) - 1]


def _rows(features: np.ndarray, bits: int, cls: np.ndarray | None = None) -> np.ndarray:
    """Weight rows of features, for members together with the class."""
    if cls is not None:
        features = (features ^ (cls.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(
            0xFF51AFD7ED558CCD
        )
    return (features >> np.uint64(64 - bits)).astype(np.intp)


def _odds(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """exp of all outputs' scores for some tokens. Steps are bounded, so nothing overflows."""
    z = np.take(weights, rows[0], axis=0)
    for r in rows[1:]:
        z += np.take(weights, r, axis=0)
    z += bias
    return np.exp(z, out=z)


def _draws(features: np.ndarray, hashes: np.ndarray, depth: np.ndarray, turn: int) -> np.ndarray:
    """A number in [0, 1) for every token, from its context alone."""
    x = features[2] ^ hashes * np.uint64(0xA0761D6478BD642F)
    x += (depth.astype(np.uint64) + np.uint64(turn << 32)) * np.uint64(0xE7037ED1A0B428DB)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x8EBC6AF09C88C6E3)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)


def _drawn(odds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One output for each token, with the model's probabilities."""
    upto = odds @ np.triu(np.ones((odds.shape[1],) * 2, np.float32))
    return np.minimum((upto <= at[:, None] * upto[:, -1:]).sum(axis=1), odds.shape[1] - 1)


@dataclass
class Weights:
    """Weight rows of the two softmaxes."""

    of_class: np.ndarray
    of_member: np.ndarray

    @classmethod
    def zeros(cls, bits: int) -> Weights:
        return cls(np.zeros((1 << bits, CLASSES), np.float32), np.zeros((1 << bits, MEMBERS), np.float32))

    @property
    def bits(self) -> int:
        return len(self.of_class).bit_length() - 1

    def plus(self, change: np.ndarray) -> Weights:
        """``change`` by row and output."""
        return Weights(
            np.ascontiguousarray(self.of_class + change[:, :CLASSES]),
            np.ascontiguousarray(self.of_member + change[:, CLASSES:]),
        )


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class StoredWeights:
    """Weights as files of a shared folder, in the order of their rows; none before the first round.

    ``value``, as a broadcast's, are arrays that map one copy on this machine, which its workers share."""

    bits: int
    folder: str
    names: tuple[str, ...] = ()
    copy: str = ""
    before: str = ""

    @classmethod
    def zeros(cls, spark: SparkSession, bits: int) -> StoredWeights:
        store, folder = _file_system(path := scratch_path(spark, "lm-weights"))
        store.create_dir(folder)
        return cls(bits, path, copy=f"lm-weights-{uuid.uuid4().hex}")

    def after(self, names: list[str]) -> StoredWeights:
        return StoredWeights(self.bits, self.folder, tuple(names), f"lm-weights-{uuid.uuid4().hex}", self.copy)

    @property
    def value(self) -> Weights:
        if self.copy not in _MAPPED:
            _MAPPED.clear()
            _MAPPED[self.copy] = self._mapped(SparkFiles.getRootDirectory())
        return _MAPPED[self.copy]

    def _mapped(self, root: str) -> Weights:
        path, n = os.path.join(root, self.copy), 1 << self.bits
        with open(f"{path}.lock", "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if not os.path.exists(path):
                self._fetch(f"{path}.part")
                os.replace(f"{path}.part", path)
                if self.before and os.path.exists(old := os.path.join(root, self.before)):
                    os.unlink(old)  # who still reads it has it open
            of_class = np.memmap(path, "<f4", "r", 0, (n, CLASSES))
            of_member = np.memmap(path, "<f4", "r", 4 * CLASSES * n, (n, MEMBERS))
        return Weights(np.asarray(of_class), np.asarray(of_member))

    def _fetch(self, path: str) -> None:
        """Writes the class weights of all files, then the member weights."""
        store, folder = _file_system(self.folder)
        with open(path, "wb") as out:
            out.truncate(4 * OUTPUTS << self.bits)
            for i, name in enumerate(self.names):
                with store.open_input_stream(f"{folder}/{name}") as rows:
                    data = rows.read()
                cut = len(data) // OUTPUTS * CLASSES
                out.seek(i * cut)
                out.write(data[:cut])
                out.seek((4 * CLASSES << self.bits) + i * (len(data) - cut))
                out.write(data[cut:])


#: The mapped weights of this process.
_MAPPED: dict[str, Weights] = {}


def step_of(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """The gradient over its curvature."""
    return 2 * RATE * (seen - expected) / (seen + expected + 2 * PRIOR)


def _outcomes(
    weights: Weights, lexicon: Lexicon, batches: Iterator[pa.RecordBatch], turn: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Places of weights (by row and output): 0 and those whose output followed its
    feature, 1 and those that the model drew. Once each time."""
    bits = weights.bits
    class_bias, member_bias = lexicon.class_bias(), lexicon.member_bias()

    def places_of(rows: np.ndarray, outputs: np.ndarray, drawn: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for of, chosen in enumerate((outputs, drawn)):
            yield of, (rows * OUTPUTS + chosen).ravel()

    for _, _, docs, places, seen in _chunks(batches, lexicon):
        starts, leaf = _starts(docs), seen.leaf[places]
        features, cls = _features(places, starts, seen), class_of(leaf)
        at = _draws(features, seen.hash[places], _depth(len(leaf), starts), turn)
        rows, drawn = _rows(features, bits), np.empty(len(leaf), np.int64)
        for some in _slices(len(leaf)):
            drawn[some] = _drawn(_odds(weights.of_class, class_bias, rows[:, some]), at[some])
        yield from places_of(rows, cls, drawn)
        inside = np.flatnonzero(leaf >= OWN_CLASSES)
        shared, member = (leaf[inside] - OWN_CLASSES) // MEMBERS, (leaf[inside] - OWN_CLASSES) % MEMBERS
        rows, drawn = _rows(features[:, inside], bits, shared), np.empty(len(inside), np.int64)
        at = (at[inside] * np.float32(4099)) % np.float32(1)
        for some in _slices(len(inside)):
            drawn[some] = _drawn(_odds(weights.of_member, member_bias[shared[some]], rows[:, some]), at[some])
        yield from places_of(rows, CLASSES + member, CLASSES + drawn)


def _gradient(weights: Weights, lexicon: Lexicon, batches: Iterator[pa.RecordBatch], turn: int) -> np.ndarray:
    """How often each weight's output followed its feature, and was expected to."""
    sums = np.zeros((2, OUTPUTS << weights.bits), np.int32)
    for of, places in _outcomes(weights, lexicon, batches, turn):
        np.add.at(sums[of], places, np.int32(1))
    return sums


def _summed(some: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and how often they come. Empties the list."""
    keys = np.concatenate(some)
    some.clear()
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.diff(first, append=len(keys))


def _gradient_parts(
    weights: Weights, lexicon: Lexicon, batches: Iterator[pa.RecordBatch], turn: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`_gradient` as keys (twice a weight's place, and one more for those expected) and
    counts other than 0, of about KEPT outcomes at a time. A key comes again in a later part."""
    some, n = [], 0
    for of, places in _outcomes(weights, lexicon, batches, turn):
        if len(places):
            some.append(places * 2 + of)
            n += len(places)
        if n > KEPT:
            yield _summed(some)
            n = 0
    if some:
        yield _summed(some)


def _slices(n: int) -> list[slice]:
    return [slice(at, at + MINIBATCH) for at in range(0, n, MINIBATCH)]


def _context_scores(weights: Weights, lexicon: Lexicon, places: np.ndarray, starts: np.ndarray, seen: _Seen) -> np.ndarray:
    """log10 of P(class | context) * P(member | class, context) for each token."""
    leaf, features = seen.leaf[places], _features(places, starts, seen)
    cls, out = class_of(leaf), np.empty(len(leaf))

    def chosen(odds: np.ndarray, outputs: np.ndarray) -> np.ndarray:
        return np.log10(odds[np.arange(len(odds)), outputs] / (odds @ np.ones(odds.shape[1], np.float32)))

    rows, bias = _rows(features, weights.bits), lexicon.class_bias()
    for some in _slices(len(leaf)):
        out[some] = chosen(_odds(weights.of_class, bias, rows[:, some]), cls[some])
    inside = np.flatnonzero(leaf >= OWN_CLASSES)
    shared, member = (leaf[inside] - OWN_CLASSES) // MEMBERS, (leaf[inside] - OWN_CLASSES) % MEMBERS
    rows, bias = _rows(features[:, inside], weights.bits, shared), lexicon.member_bias()
    for some in _slices(len(inside)):
        out[inside[some]] += chosen(_odds(weights.of_member, bias[shared[some]], rows[:, some]), member[some])
    return out


def _starts(docs: _Docs) -> np.ndarray:
    return np.cumsum(docs.lengths) - docs.lengths


def _packed(counts: np.ndarray) -> bytes:
    """Compressed counts, byte by byte of their places: most are zero or small."""
    planes = counts.astype("<i4").reshape(-1, 1).view(np.uint8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64)


def _train(shared: Broadcast, common: Broadcast, turn: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _gradient(common.value, shared.value, batches, turn).reshape(2, -1, BLOCK_ROWS * OUTPUTS)
        for block in np.flatnonzero(sums[0].any(axis=1)):
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([int(block)], pa.int32()),
                    "sums": pa.array([_packed(sums[:, block])], pa.binary()),
                }
            )

    return train


def _keys_a_file(bits: int) -> int:
    return 2 * OUTPUTS << min(bits, FILE_BITS)


def _train_parts(shared: Broadcast, common: StoredWeights, turn: int):
    """Counts by file: gaps between their keys there, then the counts."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _keys_a_file(common.bits)
        for keys, counts in _gradient_parts(common.value, shared.value, batches, turn):
            file, key = np.divmod(keys, width)
            first = np.flatnonzero(np.diff(file, prepend=-1))
            for at, end in pairwise([*first.tolist(), len(keys)]):
                packed = _packed(np.r_[np.diff(key[at:end], prepend=0), counts[at:end]])
                yield pa.RecordBatch.from_pydict(
                    {"file": pa.array([int(file[at])], pa.int32()), "sums": pa.array([packed], pa.binary())}
                )

    return train


def _write_rows(common: StoredWeights, turn: int):
    """Adds up the counts of each file, as many as its rows have at most, and writes the rows after
    the step. A task that runs twice writes two files; one of their names is given back."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for file, part in zip(batch.column("file").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                into = sums.setdefault(file, np.zeros(_keys_a_file(common.bits), np.int64))
                if part is not None:
                    gaps, counts = _unpacked(part).reshape(2, -1)
                    into[np.cumsum(gaps)] += counts
        store, folder = _file_system(common.folder)
        for file, both in sums.items():
            n = len(both) // (2 * OUTPUTS)
            rows, old = slice(file * n, (file + 1) * n), common.value
            change = step_of(*both.reshape(-1, 2).T).astype("<f4").reshape(n, OUTPUTS)
            new = Weights(old.of_class[rows], old.of_member[rows]).plus(change)
            name = f"{turn}-{file}-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{folder}/{name}") as out:
                out.write(new.of_class.tobytes() + new.of_member.tobytes())
            yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()), "name": [name]})

    return write


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the counts of each block, as many as the model has at most, and gives its step."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
            sums[block] = sums.get(block, 0) + _unpacked(part)
    for block, both in sums.items():
        change = step_of(*both.reshape(2, -1)).astype("<f4").tobytes()
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array([block], pa.int32()), "change": pa.array([change], pa.binary())}
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[pa.Table] = []

    def summed() -> pa.Table:
        both = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return both.select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in batches:
        texts = batch.column("text")
        for at, end in _slices_of(texts):
            words = split_texts(texts.slice(at, end - at)).flatten().cast(pa.binary())
            parts.append(pa.table(words.value_counts().flatten(), names=["word", "n"]))
            if sum(map(len, parts)) > REMEMBERED:
                parts = [summed()]
                if len(parts[0]) > REMEMBERED // 2:
                    yield from parts[0].to_batches()
                    parts = []
    if parts:
        yield from summed().to_batches()


def _leaf_mass(own: dict[bytes, int]):
    def mass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, lookup = np.zeros(LEAVES), _Lookup(Lexicon(own, {}, np.empty(0)))
        for batch in batches:
            sums += np.bincount(lookup.of(batch.column("word")).leaf, batch.column("n").to_numpy() + 0.5, LEAVES)
        yield pa.RecordBatch.from_pydict({"leaf": pa.array(range(LEAVES), pa.int32()), "mass": pa.array(sums)})

    return mass


def _score(shared: Broadcast, model: Broadcast | StoredWeights):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = shared.value, model.value
        log_mass = np.log10(lexicon.mass)
        part, n_rows = TaskContext.get().partitionId(), 0
        for batch, rows_in, docs, places, seen in _chunks(batches, lexicon):
            starts = _starts(docs)
            by_context = _context_scores(weights, lexicon, places, starts, seen) - log_mass[seen.leaf[places]]
            logs = seen.log_count[places]
            rare = np.isnan(logs)
            logs[rare] = 0.0
            words, times = docs.counts(rare)
            yield pa.RecordBatch.from_pydict(
                {
                    "uid": pa.array(np.arange(len(docs)) + ((part << 36) + n_rows), pa.int64()),
                    "id": batch.column("id").slice(rows_in.start, len(docs)),
                    "held_out": batch.column("held_out").slice(rows_in.start, len(docs)),
                    "n_tokens": pa.array(docs.lengths),
                    "n_frequent": pa.array(np.add.reduceat((~rare).astype(np.int64), starts)),
                    "logs": pa.array(np.add.reduceat(logs, starts)),
                    "by_context": pa.array(np.add.reduceat(by_context, starts)),
                    "words": words,
                    "times": times,
                }
            )
            n_rows += len(docs)

    return score


SCORED = (
    "uid bigint, id bigint, held_out boolean, n_tokens bigint, n_frequent bigint, logs double, by_context double, "
    "words array<binary>, times array<bigint>"
)


def count_words(train: DataFrame) -> DataFrame:
    """``word``, ``n`` over all training texts, ends included."""
    parts = train.select("text").mapInArrow(_count, "word binary, n bigint")
    return cut_lineage(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def row_bits(tokens: int) -> int:
    return max(MIN_ROW_BITS, (tokens // TOKENS_PER_ROW).bit_length() - 1)


def train_model(texts: DataFrame, lexicon: Lexicon, bits: int, rounds=ROUNDS) -> Weights | StoredWeights:
    """The weights, as files if they are many. ``texts`` has ``id`` and ``text`` of the training rows; their partitions change no more than last digits."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(lexicon)
    stored = bits > HELD_BITS
    weights, low = StoredWeights.zeros(spark, bits) if stored else Weights.zeros(bits), 0.0
    share = F.pmod(F.xxhash64(F.col("id"), F.lit("round")), F.lit(10_000)) / F.lit(10_000.0)
    for turn, part in enumerate(rounds):
        high = 2.0 if turn == len(rounds) - 1 else low + part
        mine, low = texts.filter((share >= low) & (share < high)).select("text"), high
        if stored:
            weights = _next_files(weights, mine, shared, turn)
            continue
        common = spark.sparkContext.broadcast(weights)
        counts = mine.mapInArrow(_train(shared, common, turn), "block int, sums binary")
        steps = counts.repartition(16, "block").mapInArrow(_steps, "block int, change binary")
        change = np.zeros(((1 << bits) // BLOCK_ROWS, BLOCK_ROWS * OUTPUTS), np.float32)
        for row in steps.toLocalIterator():  # at most the model's blocks
            change[row["block"]] = np.frombuffer(row["change"], "<f4")
        weights = weights.plus(change.reshape(-1, OUTPUTS))
    return weights


def _next_files(weights: StoredWeights, texts: DataFrame, shared: Broadcast, turn: int) -> StoredWeights:
    """The weights after a round. A file that nothing was counted for is written again too."""
    spark, files = texts.sparkSession, 1 << max(0, weights.bits - FILE_BITS)
    kept = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")  # the counts are read once
    try:
        counts = texts.mapInArrow(_train_parts(shared, weights, turn), "file int, sums binary")
        every = spark.range(files).selectExpr("cast(id as int) as file", "cast(null as binary) as sums")
        parts = counts.unionByName(every).repartition(max(16, files), "file")
        names = parts.mapInArrow(_write_rows(weights, turn), "file int, name string").collect()  # one a file
    finally:
        spark.conf.set(DROP_SHUFFLES, kept)
    return weights.after([name for _, name in sorted(names)])


def score_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None
) -> DataFrame:
    """One row per document: ``id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` (both log10 probabilities).

    Learns from the rows where ``held`` is false (crc32 of the id as text, modulo
    5, is 1 unless given). Null text is empty: one token, the end. A null id hashes as empty
    text. Repeated rows are learned from and scored each for itself. Without any
    training row all counts are 0. An empty table gives an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        (held_out(id_col) if held is None else held).alias("held_out"),
    )
    train = rows.filter(~F.col("held_out"))
    counts = count_words(train)
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # bounded: at most FREQUENT words can have that share, and the end
    often = counts.filter((F.col("n") * FREQUENT >= n) | (F.length("word") == 0)).collect()
    frequent = {bytes(r["word"]): r["n"] for r in often}
    top = sorted(frequent, key=lambda w: (-frequent[w], w))[:OWN_CLASSES]
    own = {w: i for i, w in enumerate(top)}
    mass = np.full(LEAVES, 1e-9)
    mass[OWN_CLASSES:] += 0.5  # a share of each for words never seen
    parts = counts.mapInArrow(_leaf_mass(own), "leaf int, mass double")
    for r in parts.groupBy("leaf").agg(F.sum("mass").alias("mass")).collect():
        mass[r["leaf"]] += r["mass"]
    lexicon = Lexicon(own, frequent, mass)
    bits = row_bits(n)
    weights = train_model(train, lexicon, bits) if n else Weights.zeros(bits)
    shared = spark.sparkContext.broadcast(lexicon)
    model = weights if isinstance(weights, StoredWeights) else spark.sparkContext.broadcast(weights)
    scored = cut_lineage(rows.mapInArrow(_score(shared, model), SCORED), "scored")

    rare = scored.select("uid", F.explode(F.arrays_zip("words", "times")).alias("x"))
    rare = rare.select("uid", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    known = counts.filter((F.col("n") * FREQUENT < n) & (F.length("word") > 0))
    looked_up = rare.join(known, "word", "left").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("rare_logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(F.lit(0))).alias("n_rare"),
    )
    joined = scored.drop("words", "times").join(looked_up, "uid", "left")
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return joined.select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(n + 0.5 * (v + 1)))).alias("base_score"),
        (logs + F.col("by_context")).alias("score"),
    )


def op6_query(spark: SparkSession, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    return score_documents(docs).withColumnRenamed("id", "doc_id")
