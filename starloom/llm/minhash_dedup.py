"""MinHash near-dedup with sequential Bayesian verification.

1. Every text becomes a set of word shingles (64-bit hashes). Texts with equal
   sets form one class, named by its smallest id, before anything is compared.
2. MinHash signatures are cut into bands; classes that agree in a band share a
   bucket. There are as many bands as make all buckets miss a pair at the
   threshold with a probability below ``MISS_BANDS`` (a closer pair is missed
   far more rarely). Long bands keep texts apart that share a passage only.
3. A bucket of g classes is never written out as g * g pairs. Round one compares
   each member with its bucket's smallest member only; a member within the
   threshold of one joins its ball. Round two compares ball centres that met in
   a bucket. Jaccard distance is a metric: if two centres are further apart than
   the threshold's distance plus both radii, no members of theirs can link, which
   settles nearly all. Round three compares members of the balls that
   remain. The smaller ball of a pair visits the larger one, which is cut into parts
   of a bounded size; a visitor is compared with a part's members inside one task,
   where the members are far enough out to reach it, and only links leave the
   task. What is shuffled grows with the smaller balls, not with their products.
4. In each round a pair's signatures are compared in batches of 32 positions. A
   pair is dropped once the posterior probability that its similarity reaches
   the bound falls below ``MISS_VERIFY`` (uniform prior, so a Beta posterior).
   Survivors are counted exactly on the full sets.
5. Links give connected components; a class's members follow it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.session import cut_counted, cut_lineage

BAND_ROWS = 8
BATCH = 32
MISS_BANDS = 2e-5
MISS_VERIFY = 1e-7
CACHE_WORDS = 1 << 17
#: Texts that a task works on at a time.
ROWS = 512
FILTER_BITS = 26
#: Similarity bounds of round two are rounded down to this grid.
GRID = 0.025
#: Round three: members of a part, and shingles in it, at most (a single set may be larger).
PART_MEMBERS, PART_SHINGLES = 2048, 1 << 22
#: So many rows of ids and hashes take the room of one document.
NARROW = 2


class _WordHashes(dict):
    """Word to 64-bit hash, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows, at most ROWS at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, k: int, words: dict) -> np.ndarray:
    """Sorted distinct shingle hashes. Lower-cases A-Z, splits at ASCII white space."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    n, odd = max(1, len(h) - k + 1), _odd(k, k)
    mixed = np.full(n, min(len(h), k), np.uint64)
    for j in range(min(k, len(h))):
        mixed += h[j : j + n] * odd[j]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    odd, flip = _odd(hashes, 101), _odd(hashes, 102)
    least = np.full(hashes, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 512):
        mixed = shingles[at : at + 512, None] ^ flip
        mixed *= odd
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def band_count(threshold: float) -> int:
    """Bands of BAND_ROWS rows whose buckets miss a pair at the threshold with a
    probability of at most MISS_BANDS, in whole batches."""
    bands = math.ceil(math.log(MISS_BANDS) / math.log(1 - threshold**BAND_ROWS))
    step = BATCH // BAND_ROWS
    return -(-bands // step) * step


def least_matches(threshold: float, hashes: int) -> list[int]:
    """For 32, 64, ... compared positions: the fewest matches with which a pair
    may still reach the threshold, by the Beta(m + 1, n - m + 1) posterior."""
    out = []
    for n in range(BATCH, hashes + 1, BATCH):
        # P(similarity >= t) = P(Binomial(n + 1, t) <= m)
        p, m = 0.0, -1
        while p < MISS_VERIFY and m < n:
            m += 1
            p += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


PROFILE = "id bigint, n_shingles bigint, set_key binary, bands array<bigint>, sig binary"


def _profiles(k: int, bands: int):
    mix = _odd(bands * BAND_ROWS, 103).reshape(bands, BAND_ROWS)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in _in_slices(batches):
            sizes, keys, buckets, sigs = [], [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), k, words)
                sizes.append(len(s))
                if not len(s):
                    keys.append(None), buckets.append(None), sigs.append(None)
                    continue
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                least = signature(s, bands * BAND_ROWS)
                cut = (least.reshape(bands, BAND_ROWS) * mix).sum(axis=1)
                cut ^= cut >> np.uint64(31)
                cut = cut * mix[:, 0] + np.arange(bands, dtype=np.uint64)
                buckets.append(cut.view(np.int64))
                sigs.append((least >> np.uint64(24)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(buckets, pa.list_(pa.int64())),
                    pa.array(sigs, pa.binary()),
                ],
                names=["id", "n_shingles", "set_key", "bands", "sig"],
            )

    return profile


def _place(ids: np.ndarray, bits: int) -> np.ndarray:
    """An id's bit in a filter of 2**bits."""
    return (ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _marks(bits: int):
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)
        for batch in batches:
            seen[_place(batch.column("id").to_numpy(), bits)] = True
        yield pa.RecordBatch.from_pydict({"marks": pa.array([np.packbits(seen).tobytes()], pa.binary())})

    return marks


def _filter_of(ids: DataFrame) -> np.ndarray:
    """One bit per hashed id, at most 2**FILTER_BITS: what lets most other
    documents be left out without a join. It may let some through."""
    n = ids.count()
    bits = min(FILTER_BITS, max(10, (16 * n).bit_length()))
    out = np.zeros(1 << bits, bool)
    # as many parts as hold about two million ids each
    for row in ids.coalesce(-(-n // 2_000_000) or 1).mapInArrow(_marks(bits), "marks binary").toLocalIterator():
        out |= np.unpackbits(np.frombuffer(row["marks"], np.uint8)).astype(bool)
    return out


def _sets(k: int, wanted: Broadcast):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, marks = _WordHashes(), wanted.value
        bits = len(marks).bit_length() - 1
        for batch in _in_slices(batches):
            batch = batch.filter(pa.array(marks[_place(batch.column("id").to_numpy(), bits)]))
            found = [shingle_set(t.as_py(), k, words).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=["id", "set"])

    return sets


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose similarity may reach their ``bound``; adds ``matches``."""
    least: dict[float, list[int]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            for c in ("sig_a", "sig_b")
        )
        hashes = left.shape[1]
        bound = batch.column("bound").to_numpy()
        for b in np.unique(bound):
            least.setdefault(b, least_matches(float(b), hashes))
        alive = np.arange(batch.num_rows)
        matches = np.zeros(batch.num_rows, np.int64)
        for step, at in enumerate(range(0, hashes, BATCH)):
            matches[alive] += (left[alive, at : at + BATCH] == right[alive, at : at + BATCH]).sum(axis=1)
            need = np.array([least[b][step] for b in bound[alive]])
            alive = alive[matches[alive] >= need]
        kept = batch.select(["a", "b", "bound"]).take(pa.array(alive))
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(matches[alive])], names=["a", "b", "bound", "matches"]
        )


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _in_slices(batches):
        shared, total = [], []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            n = len(np.intersect1d(p, q, assume_unique=True))
            shared.append(n)
            total.append(len(p) + len(q) - n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
            names=["a", "b", "shared", "total"],
        )


def _rows_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            sets = [np.frombuffer(x, np.int64) for x in some.column("set").to_pylist()]
            ids = np.repeat(some.column("id").to_numpy(), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.concatenate(sets))], names=["id", "shingle"]
            )


def _enough(c1, least1, most1, c2, least2, most2, t: float):
    """Whether sets of these sizes, with at most c1 and c2 shingles that any other set
    has too, may reach the similarity t."""
    shared = F.least(c1, c2) * (1 + t) >= t * (F.col(least1) + F.col(least2))
    return shared & (F.col(most1) >= t * F.col(least2)) & (F.col(most2) >= t * F.col(least1))


VISIT = "host bigint, part int, guest boolean, id bigint, far double, slack double, c bigint, sig binary, set binary"


class _Side:
    """Rows of a cell in arrays."""

    def __init__(self, rows: pa.Table | pa.RecordBatch):
        self.ids, self.far, self.slack, self.common = (rows.column(c).to_numpy() for c in ("id", "far", "slack", "c"))
        self.sets = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
        self.sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.size = np.array([len(x) for x in self.sets])


class _Hosts(_Side):
    """A part's members, and which of them have a shingle."""

    def __init__(self, rows: pa.Table):
        super().__init__(rows)
        held = np.concatenate(self.sets)
        order = np.argsort(held, kind="stable")
        self.held, self.holder = held[order], np.repeat(np.arange(len(self.ids), dtype=np.int32), self.size)[order]


def _links(own: _Hosts, guests: _Side, threshold: float, percent: int) -> pa.RecordBatch | None:
    t, least, found = threshold - 1e-9, least_matches(threshold, own.sig.shape[1]), []
    for g, (guest, size) in enumerate(zip(guests.ids, guests.size, strict=True)):
        may = own.far + guests.far[g] + guests.slack[g] >= 0
        may &= np.minimum(own.common, guests.common[g]) * (1 + t) >= t * (own.size + size)
        may &= (np.maximum(own.size, size) * t <= np.minimum(own.size, size)) & (own.ids != guest)
        alive = np.flatnonzero(may)
        matches = np.zeros(len(alive), np.int64)
        for step, at in enumerate(range(0, own.sig.shape[1], BATCH)):
            matches += (own.sig[alive, at : at + BATCH] == guests.sig[g, at : at + BATCH]).sum(axis=1)
            still = matches >= least[step]
            alive, matches = alive[still], matches[still]
        if not len(alive):
            continue
        first, last = np.searchsorted(own.held, guests.sets[g]), np.searchsorted(own.held, guests.sets[g], side="right")
        hits = np.repeat(first - np.r_[0, np.cumsum(last - first)[:-1]], last - first) + np.arange((last - first).sum())
        shared = np.bincount(own.holder[hits], minlength=len(own.ids))[alive]
        near = alive[shared * 100 >= (own.size[alive] + size - shared) * percent]
        found += [(own.ids[k], guest) for k in near]
    if not found:
        return None
    a, b = np.array(found, np.int64).T
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _visited(threshold: float, percent: int):
    """Links between a part's members, which come first and are held, and its guests, which pass by."""

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members, hosts = None, [], None
        for batch in _in_slices(batches):
            keys = np.stack([batch.column(c).cast(pa.int64()).to_numpy() for c in ("host", "part", "guest")])
            bounds = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for at, end in pairwise(bounds):
                host, part, guest = keys[:, at].tolist()
                if (host, part) != cell:
                    cell, members, hosts = (host, part), [], None
                rows = batch.slice(at, end - at)
                if not guest:
                    members.append(rows)
                elif members:
                    hosts = hosts or _Hosts(pa.Table.from_batches(members))
                    links = _links(hosts, _Side(rows), threshold, percent)
                    if links is not None:
                        yield links

    return visited


def _visits(apart: DataFrame, members: DataFrame, sigs: DataFrame, sets: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Links between members of balls that are apart: (a, b, ra, rb, slack) names the
    balls, ``members`` their (centre, id, far, n, c)."""
    t = threshold - 1e-9
    # what no member of a ball exceeds: sizes, and shingles that another class has too
    balls = members.groupBy("centre").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("c").alias("c")
    )
    for side in ("a", "b"):
        apart = apart.join(balls.select(*[F.col(c).alias(side if c == "centre" else f"{c}_{side}") for c in balls.columns]), side)
    apart = apart.filter(_enough("c_a", "least_a", "most_a", "c_b", "least_b", "most_b", t))
    host_a = F.struct("m_a", "a") >= F.struct("m_b", "b")

    def of_host(x: str):
        return F.when(host_a, F.col(x.format("a"))).otherwise(F.col(x.format("b")))

    pairs = apart.select(
        of_host("{}").alias("host"),
        F.when(host_a, F.col("b")).otherwise(F.col("a")).alias("centre"),
        "slack",
        of_host("r{}").alias("r_host"),
        *[of_host(c + "_{}").alias(c + "_host") for c in ("m", "w", "least", "most", "c")],
    )
    many = F.greatest(F.ceil(F.col("m_host") / PART_MEMBERS), F.ceil(F.col("w_host") / PART_SHINGLES)).cast("int")
    pairs, _ = cut_counted(pairs.withColumn("parts", many), "ball-pairs", NARROW)
    can_reach = F.col("far") + F.col("r_host") + F.col("slack") >= 0
    can_reach &= _enough("c", "n", "n", "c_host", "least_host", "most_host", t)
    guests = pairs.join(members, "centre").filter(can_reach)
    guests = cut_lineage(guests.select("host", "parts", F.lit(True).alias("guest"), "id", "far", "slack", "c"), "guests")
    hosts = guests.select("host", "parts").distinct()
    at_home = members.withColumnRenamed("centre", "host").join(hosts, "host")
    none = F.lit(0.0).alias("slack")
    at_home = at_home.select("host", "parts", F.lit(False).alias("guest"), "id", "far", none, "c")
    texts = sets.join(sigs, "id").select("id", "sig", "set")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    seated = guests.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    seated = seated.unionByName(at_home.withColumn("part", part)).join(texts, "id")
    names = [c.split()[0] for c in VISIT.split(", ")]
    cells = seated.select(*names).repartition("host", "part").sortWithinPartitions("host", "part", "guest")
    return cells.mapInArrow(_visited(threshold, percent), "a bigint, b bigint").distinct()


def _with_radii(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(stats.select(F.col("id").alias(side), F.col("r").alias(f"r{side}")), side)
    return pairs.withColumn("radii", F.col("ra") + F.col("rb"))


def _promising(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    left = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "bound", "sig_a", "sig_b")
    return both.mapInArrow(_may_link, "a bigint, b bigint, bound double, matches bigint")


def _exact(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(_count_shared, "a bigint, b bigint, shared bigint, total bigint")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id``, ``kept``: one row per input row.

    Two documents are linked when 100 * shared >= ``percent`` * all shingles of the
    two. Words are split at ASCII white space after lower-casing A-Z; a text
    with fewer than ``k`` words is one shingle; a null or empty text, or one of
    white space only, has none and links with nothing. ``component_id`` is the
    smallest id reachable, ``kept`` says that it is the row's own. Ids are
    integers. Rows of one id are one document, linked if any of its texts is. A row
    with a null id links with nothing: its component is null and it is kept.
    An empty table gives an empty result; other columns are not read.
    """
    threshold = percent / 100
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    profiles = cut_lineage(texts.mapInArrow(_profiles(k, band_count(threshold)), PROFILE), "profiles")
    n_texts = profiles.count()
    n_rows = n_texts // NARROW
    named = profiles.filter(F.col("id").isNotNull() & F.col("set_key").isNotNull())
    # the smallest id of a class brings its bands and signature along
    first = F.min(F.struct("id", "bands", "sig")).alias("first")
    classes = cut_lineage(named.groupBy("set_key").agg(first).select("set_key", "first.*"), "classes", n_rows)
    sigs = classes.select("id", "sig")

    met = classes.select("id", F.explode("bands").alias("bucket"))
    leaders = met.groupBy("bucket").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n"))
    leaders = cut_lineage(leaders.filter("n > 1").select("bucket", "leader"), "leaders", n_rows)
    met = cut_lineage(met.join(leaders, "bucket"), "buckets", n_rows)

    # round one: members against the smallest of their buckets
    stars = met.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    hopeful = _promising(stars.withColumn("bound", F.lit(threshold)), sigs)
    best = hopeful.groupBy("b").agg(F.max(F.struct("matches", -F.col("a"))).alias("m"))
    best = best.select((-F.col("m")["col2"]).alias("a"), "b")
    # the full sets of what met in a bucket (and of some documents more)
    wanted = texts.sparkSession.sparkContext.broadcast(_filter_of(met.select("id").distinct()))
    named_texts = texts.filter(F.col("id").isNotNull())
    sets = cut_lineage(
        named_texts.mapInArrow(_sets(k, wanted), "id bigint, set binary").filter("length(set) > 0"), "sets", n_texts
    )
    near = F.col("shared") * 100 >= F.col("total") * percent
    balls = cut_lineage(
        _exact(best, sets)
        .filter(near)
        .groupBy(F.col("b").alias("id"))
        .agg(F.max(F.struct((F.col("shared") / F.col("total")).alias("s"), F.col("a").alias("centre"))).alias("x"))
        .select("id", "x.centre", (1 - F.col("x.s")).alias("far")),
        "balls",
        n_rows,
    )
    # round two: centres that met in a bucket through any of their members
    own = met.select("bucket", "id").join(balls, "id", "left")
    placed = cut_lineage(
        own.select("bucket", "id", F.coalesce("centre", "id").alias("centre"), F.coalesce("far", F.lit(0.0)).alias("far")),
        "placed",
        n_rows,
    )
    # what a centre can share at most: its shingles that another class has too
    alone = (
        sets.mapInArrow(_rows_of_sets, "id bigint, shingle bigint")
        .groupBy("shingle")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
        .filter("n = 1")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    radius = placed.groupBy(F.col("centre").alias("id")).agg(F.max("far").alias("r"))
    size = (F.length("set") / 8).cast("bigint")
    of_id = sets.groupBy("id").agg(F.min(size).alias("n"), F.sum(size).alias("all"), F.count(F.lit(1)).alias("m"))
    # an id with several texts may share anything
    common = F.when(F.col("m") == 1, F.col("n") - F.coalesce("alone", F.lit(0))).otherwise(F.col("all"))
    bounds = cut_lineage(of_id.join(alone, "id", "left").select("id", "n", common.alias("c")), "bounds", n_rows)
    stats = cut_lineage(bounds.join(radius, "id"), "stats", n_rows)
    seats = placed.select("bucket", F.col("centre").alias("id")).distinct().join(stats, "id")
    one, two = (seats.select("bucket", *[F.col(c).alias(x + c) for c in ("id", "n", "c", "r")]) for x in "ab")
    # a pair counts only if the shared shingles could reach the bound; as a part of
    # the join, that keeps a bucket's pairs from being written out
    reach = F.lit(threshold - 1e-9) - F.col("ar") - F.col("br")
    can = F.least("ac", "bc") * (reach + 1) >= reach * (F.col("an") + F.col("bn"))
    met_there = (one["bucket"] == two["bucket"]) & (F.col("aid") < F.col("bid")) & can
    reach = (
        one.join(two, met_there)
        .select(F.col("aid").alias("a"), F.col("bid").alias("b"), F.col("ar").alias("ra"), F.col("br").alias("rb"))
        .distinct()
        .withColumn("radii", F.col("ra") + F.col("rb"))
    )
    bound = F.floor((F.lit(threshold) - F.col("radii")) / F.lit(GRID) + F.lit(1e-9)) * F.lit(GRID)
    asked = reach.withColumn(
        "bound", F.when(F.col("radii") > 0, F.greatest(F.lit(GRID), bound)).otherwise(F.lit(threshold))
    )
    told = _exact(_promising(asked.select("a", "b", "bound"), sigs), sets)
    told, n_told = cut_counted(_with_radii(told, stats), "centres", NARROW)
    n_pairs = n_told // NARROW
    links = told.filter(near).select("a", "b")
    links = links.unionByName(balls.select(F.col("id").alias("a"), F.col("centre").alias("b")))

    # round three: members of balls that are still apart and may touch
    apart = told.filter(~near & (1 - F.col("shared") / F.col("total") <= 1 - threshold + F.col("radii") + 1e-9))
    roots = cut_lineage(components(links, rows=n_rows + n_pairs), "roots", n_rows)
    for side in ("a", "b"):
        apart = apart.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    apart = apart.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    apart = cut_lineage(
        apart.select("a", "b", "ra", "rb", (F.col("shared") / F.col("total") + (1e-9 - threshold)).alias("slack")),
        "apart",
        n_pairs,
    )
    if apart.limit(1).count():
        members = cut_lineage(placed.select("centre", "id", "far").distinct().join(bounds, "id"), "members", n_rows)
        more, n_more = cut_counted(_visits(apart, members, sigs, sets, threshold, percent), "links", NARROW)
        if n_more:
            linked = components(links.unionByName(more), rows=n_rows + n_pairs + n_more // NARROW)
            roots = cut_lineage(linked, "roots", n_rows)
    joined = classes.select("set_key", "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
    named_by = joined.select("set_key", F.col("id").alias("class_id"), F.coalesce("root", "id").alias("component_id"))
    named_by = cut_lineage(named_by, "components", n_rows)
    # a row with a null id keeps its set to itself
    asks = profiles.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("set_key")).alias("set_key"))
    out = asks.join(named_by, "set_key", "left")
    return out.select(
        "id",
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each group, with its own columns; rows of one id are one
    document and leave one row. Documents with a null id all stay."""
    judged = near_duplicates(docs, id_col=id_col, **options)
    keep = judged.filter(F.col("kept") & F.col("id").isNotNull()).select(F.col("id").alias(id_col)).distinct()
    known = docs.join(keep, id_col, "left_semi").dropDuplicates([id_col])
    return known.unionByName(docs.filter(F.col(id_col).isNull()))


def op1_query(spark: SparkSession, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, k=3, percent=85).withColumnRenamed("id", "doc_id")


OP1_SQL = """
with recursive d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w
  from documents
), s as (
  select distinct doc_id, array_to_string(w[i:i + 2], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from d where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id
), links as (
  select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * c >= 85 * (x.n + y.n - c)
), both_ways as (
  select a, b from links union all select b, a from links
), reach(a, b) as (
  select a, b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a
), least_of as (
  select a, min(b) as m from reach group by a
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) as kept
from d left join n using (doc_id) left join least_of on a = d.doc_id
"""
