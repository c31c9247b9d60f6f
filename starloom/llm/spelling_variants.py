"""Spelling variants: words one edit apart, found through pivotal grams.

1. Tasks count the words of their texts; counts are added up by word.
2. Bigrams are ordered by the number of words they stand in. A word's prefix are
   its three rarest bigrams (and all that tie with the third); its two pivots are
   the two bigrams of the prefix that share no character and are rarest together,
   chosen by dynamic programming over positions. One edit leaves one of two
   disjoint pivots whole, and of two near words the one whose prefix ends earlier
   in the order has that pivot inside the other's prefix.
3. So pivots are looked up among the other words' prefix grams. Position limits:
   the edit lies behind the shared gram, which then stands at the same place from
   the start with the same letters before it, or in front of it, likewise from the
   end. On that side it lies in the nearer or the farther half, so the other half
   is equal too. (gram place, equal letters) is the key of the lookup; a word asks
   for halves of its own length and of one letter more, so the shorter word of a
   pair meets the longer one. No pair is lost and few meet in vain.
4. Pairs that meet are verified by their edit distance inside the join, so only
   near pairs leave it.
5. A word's form is its most frequent near word; roots follow forms by doubling.

A word that repeats one bigram more than ``REPEATS`` times (a long run of a letter)
would have as many tied grams; such words, and those that may be one edit from
them, are looked up by equal halves instead.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import cut_counted, cut_lineage, few_parts

MIN_LENGTH = 7
MIN_COUNT = 2
#: A word's form stands at least this many times as often.
FORM_FACTOR = 10
#: One in so many (document, word) pairs loses a letter.
DROP_ONE_IN = 31
REPEATS = 60
#: So many rows of words take the room of one document.
NARROW = 8
#: Words that a task remembers before it hands on their counts.
HELD_WORDS = 300_000

#: Latin-1 letters A-Z a-z and from C0 stay (A-Z lower-cased); all else separates.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def text_words(doc_id: str, text: str, min_length: int, drop_one_in: int) -> Counter:
    """The text's words of ``min_length`` or more, as Latin-1 bytes, with counts."""
    runs = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
    start, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in runs.items():
        if len(run) < min_length:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if drop_one_in and h % drop_one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < min_length:
                continue
        out[run] += n
    return out


def _counts(min_length: int, drop_one_in: int):
    def batch_of(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text"), strict=True):
                if text.is_valid:
                    held.update(text_words(doc_id.as_py() or "", text.as_py(), min_length, drop_one_in))
                if len(held) > HELD_WORDS:
                    yield batch_of(held)
                    held = Counter()
        yield batch_of(held)

    return count


def _bigrams(word: bytes) -> list[bytes]:
    return [word[k : k + 2] for k in range(len(word) - 1)]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            held.update(set(_bigrams(word.encode("latin-1"))))
    grams = pa.array([g.decode("latin-1") for g in held], pa.string())
    yield pa.RecordBatch.from_arrays([grams, pa.array(held.values(), pa.int64())], names=["gram", "n"])


def prefix_of(word: bytes, order: dict[bytes, tuple[int, int]]) -> list[int]:
    """Positions of the three rarest bigrams and of all that tie with the third."""
    ranked = sorted((order[g], at) for at, g in enumerate(_bigrams(word)))
    return sorted(at for rank, at in ranked if rank <= ranked[2][0])


def pivots_of(word: bytes, prefix: list[int], order: dict[bytes, tuple[int, int]]) -> tuple[int, int]:
    """The two disjoint positions of the prefix with the least sum of counts. best[i]
    is the cheapest single gram among the first i; a pair adds the cheapest that ends
    before its second gram begins."""
    weight = [order[word[at : at + 2]][0] for at in prefix]
    best: list[int] = []
    pair: tuple[int, int, int] | None = None
    free = 0
    for i, at in enumerate(prefix):
        while prefix[free] + 2 <= at:
            free += 1
        if free:
            first = best[free - 1]
            cost = weight[first] + weight[i]
            if pair is None or cost < pair[0]:
                pair = (cost, prefix[first], at)
        best.append(i if not best or weight[i] < weight[best[-1]] else best[-1])
    assert pair is not None  # three positions always hold two disjoint bigrams
    return pair[1], pair[2]


def _place(*parts) -> int:
    """A lookup key: 64 bits of numbers and letters."""
    text = b"".join(p.to_bytes(4, "big") if isinstance(p, int) else p for p in parts)
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def lookups(word: bytes, order: dict[bytes, tuple[int, int]]) -> dict[int, bool]:
    """The word's lookup keys; the value says whether a pivot made the key."""
    size, out = len(word), {}
    most = max(Counter(_bigrams(word)).values()) if size > REPEATS else 1
    if most > REPEATS - 2:
        for length in (size, size + 1):
            half = length // 2
            out[_place(4, half, word[:half])] = True
            out[_place(5, length - half, word[size - (length - half) :])] = True
    if most > REPEATS:
        return out
    prefix = prefix_of(word, order)
    pivots = pivots_of(word, prefix, order)
    for at in prefix:
        from_end, head, tail = size - at, word[: at + 2], word[at:]
        keys = set()
        for length in (size, size + 1):
            behind, before = length - at - 2, length - from_end
            near, far = behind // 2, behind - behind // 2
            keys.add(_place(0, at, near, word[: at + 2 + near]))
            keys.add(_place(1, at, far, head, word[size - far :] if far else b""))
            near, far = before // 2, before - before // 2
            keys.add(_place(2, from_end, near, word[max(at - near, 0) :]))
            keys.add(_place(3, from_end, far, tail, word[:far]))
        for key in keys:
            out[key] = out.get(key, False) or at in pivots
    return out


def _index(order: Broadcast):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                some = batch.slice(start, 2000)
                found = [lookups(w.encode("latin-1"), order.value) for w in some.column("word").to_pylist()]
                row = pa.array([k for k, keys in enumerate(found) for _ in keys], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key for keys in found for key in keys], pa.int64()),
                        pa.array([p for keys in found for p in keys.values()], pa.bool_()),
                        some.column("word").take(row),
                        some.column("n").take(row),
                    ],
                    names=["place", "pivot", "word", "n"],
                )

    return index


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``an``, ``b``, ``bn``: the pairs a < b of ``words`` (word, n; distinct
    Latin-1 words of four letters or more) that are exactly one edit apart."""
    grams = words.mapInArrow(_gram_counts, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    # at most 90 * 90 bigrams of 90 letters
    ranked = sorted((r["n"], r["gram"].encode("latin-1")) for r in grams.collect())
    order = words.sparkSession.sparkContext.broadcast({g: (n, k) for k, (n, g) in enumerate(ranked)})
    index = cut_lineage(
        words.select("word", "n").mapInArrow(_index(order), "place bigint, pivot boolean, word string, n bigint"), "word-places"
    )
    one, two = index.alias("one"), index.alias("two")
    met = (
        (F.col("one.place") == F.col("two.place"))
        & (F.col("one.word") < F.col("two.word"))
        & (F.col("one.pivot") | F.col("two.pivot"))
        & (F.levenshtein("one.word", "two.word", 1) == 1)
    )
    pairs = one.join(two, met).select(
        F.col("one.word").alias("a"), F.col("one.n").alias("an"), F.col("two.word").alias("b"), F.col("two.n").alias("bn")
    )
    return pairs.distinct()


def _roots(forms: DataFrame, rows: int, max_rounds: int = 40) -> DataFrame:
    """``word``, ``root``: where the forms (word, form) lead. Every step multiplies the
    count, and every round doubles the steps, so a few rounds do."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), "forms", rows)
    for _ in range(max_rounds):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = cut_lineage(
            now.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "forms",
            rows,
        )
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError(f"forms did not settle in {max_rounds} rounds")


def spelling_variants(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    factor: int = FORM_FACTOR,
    drop_one_in: int = DROP_ONE_IN,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row per word.

    Words are runs of Latin letters, A-Z lower-cased, of at least ``min_length`` (4
    or more) code points, that stand at least ``min_count`` times in all texts. In one of
    ``drop_one_in`` (document, run) pairs, picked by checksum, a run loses a letter (0:
    never). ``form`` is the near word with the largest count (ties: the smallest) if that
    is ``factor`` (2 or more) times the word's. Every row of the table counts, repeated
    rows too; a null text has no words, a null id counts as an empty one. An empty
    table gives an empty result; other columns are not read.
    """
    if min_length < 4 or factor < 2:
        raise ValueError("min_length has to be 4 or more and factor 2 or more")
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(_counts(min_length, drop_one_in), "word string, n bigint")
    words, n_words = cut_counted(
        counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "words", NARROW
    )
    rows = n_words // NARROW
    pairs = near_pairs(words)
    # both ways in one pass over the pairs
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("bn").alias("on"), F.col("b").alias("other")),
            F.struct(F.col("b").alias("word"), F.col("an").alias("on"), F.col("a").alias("other")),
        )
    ).alias("e")
    near = (
        pairs.select(ends)
        .select("e.*")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("on")).alias("least"), "other")).alias("best"))
        .select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.least")).alias("on"))
    )
    has_form = F.col("on") >= F.lit(factor) * F.col("n")
    told = cut_lineage(
        words.join(near, "word", "left").select(
            "word",
            F.when(has_form, F.col("other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("on")).alias("form_n"),
        ),
        "near-words",
        rows,
    )
    roots = _roots(told.filter(F.col("form").isNotNull()), rows)
    out = told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
    return few_parts(out, rows)


def op12_query(spark: SparkSession, root: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text"))


OP12_SQL = """
with recursive bits(i, c, k) as (
  select i::bigint, i::bigint, 0 from range(256) r(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8
), crc_table as (
  select list(c order by i) as t from bits where k = 8
), runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
    from documents)
  where length(run) >= 7 group by doc_id, run
), octets as (
  select doc_id, run, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x from runs
), numbers as (
  select doc_id, run, n, [
    16 * instr('0123456789ABCDEF', x[2 * i - 1]) + instr('0123456789ABCDEF', x[2 * i]) - 17
    for i in range(1, length(x) // 2 + 1)] as bs
  from octets
), sums as (
  select run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, bs::bigint[]), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) as h
  from numbers, crc_table
), words as (
  select word, sum(n)::bigint as n from (
    select case when h % 31 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, n
    from sums)
  where length(word) >= 7 group by word having sum(n) >= 2
), cuts as (
  select word, n, i, word[1:i] || word[i + 2:] as rest from (select word, n, unnest(range(0, length(word))) as i from words)
), near as (
  select a.word, b.word as other, b.n as other_n from cuts a join cuts b
    on a.rest = b.rest and a.i = b.i and a.word <> b.word and length(a.word) = length(b.word)
  union
  select a.word, b.word, b.n from cuts a join words b on a.rest = b.word
  union
  select b.word, a.word, a.n from cuts a join words b on a.rest = b.word
), best as (
  select word, count(*) as n_near, max(other_n) as top from near group by word
), forms as (
  select w.word, min(o.other) as form, max(o.other_n) as form_n
  from words w join best on best.word = w.word join near o on o.word = w.word and o.other_n = top
  where top >= 10 * w.n group by w.word
), steps(word, reached, k) as (
  select word, form, 1 from forms
  union all
  select s.word, f.form, k + 1 from steps s join forms f on f.word = s.reached
), roots as (
  select word, max_by(reached, k) as root from steps group by word
)
select w.word, form, coalesce(root, w.word) as root, n, coalesce(n_near, 0) as n_near, form_n
from words w left join best using (word) left join forms using (word) left join roots using (word)
"""
