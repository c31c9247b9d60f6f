"""Document fingerprints: one-permutation MinHash [native].

Every shingle of five words is hashed once. The top bits of a hash choose one
of 256 bins, the bin keeps its smallest hash. An empty bin borrows from a bin
that is not empty, chosen by hashes of the empty bin's own number, so that two
texts borrow alike wherever their bins agree (optimal densification): six
drawn bins are tried first, then the non-empty bin of lowest draw takes over.
A fingerprint stores the low eight bits of every bin as hex digits. Two
unequal bins agree by chance in one of 256 cases, which the likeness corrects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import text_of, windows, word_hashes, words_of
from starloom.session import cut_lineage

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
KEPT_BITS = 8
DRAWS = 6
#: Ids of one block of the document order; a block has at most 2**8 different ids.
BLOCK_BITS = 8


LOW = (1 << (64 - BIN_BITS)) - 1


def _bin(x: Column) -> Column:
    """A hash's bin, numbered in the order in which hashes sort."""
    return F.shiftright(x, 64 - BIN_BITS) + F.lit(BINS // 2).cast("bigint")


def _last_of_bins() -> Column:
    """The largest value of every bin; it stands for "empty"."""
    first = F.sequence(F.lit(-BINS // 2).cast("bigint"), F.lit(BINS // 2 - 1).cast("bigint"))
    return F.transform(first, lambda i: F.shiftleft(i, 64 - BIN_BITS).bitwiseOR(F.lit(LOW)))


def add_bins(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the kept low bits of the bins (array of 256 small numbers),
    null for a text without words. Fewer than five words are one shingle."""
    h, s, b, m = (F.col(f"_{n}_{out}") for n in "hsbm")
    df = df.withColumn(f"_h_{out}", word_hashes(words_of(F.col(text))))
    # with the last value of each bin among the hashes, every bin has a first one
    df = df.withColumn(f"_s_{out}", F.sort_array(F.concat(windows(h, SHINGLE), _last_of_bins())))
    first = F.filter(s, lambda x, i: F.coalesce(_bin(F.get(s, i - 1)) != _bin(x), F.lit(True)))
    df = df.withColumn(f"_b_{out}", F.when(F.size(h) > 0, first)).drop(f"_h_{out}", f"_s_{out}")

    def full(x: Column) -> Column:
        return x.bitwiseAND(F.lit(LOW)) != F.lit(LOW)

    df = df.withColumn(f"_m_{out}", F.transform(F.filter(b, full), _bin))
    def borrowed(i: Column) -> Column:
        drawn = [F.get(b, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(DRAWS)]
        # a draw for each bin that is not empty, with its number in the low bits
        lottery = F.transform(
            m, lambda j: F.xxhash64(i, j, F.lit(DRAWS)).bitwiseAND(F.lit(-BINS)).bitwiseOR(j)
        )
        lowest = F.get(b, F.array_min(lottery).bitwiseAND(F.lit(BINS - 1)).cast("int"))
        return F.coalesce(*[F.when(full(d), d) for d in drawn], lowest)

    dense = F.transform(
        b,
        lambda x, i: (
            F.when(full(x), x).otherwise(borrowed(i)).bitwiseAND(F.lit((1 << KEPT_BITS) - 1)) - F.lit(1 << KEPT_BITS - 1)
        ).cast("tinyint"),
    )
    return df.withColumn(out, dense).drop(f"_b_{out}", f"_m_{out}")


def packed(bins: Column) -> Column:
    """The fingerprint as hex, two digits a bin; empty for a text without words."""
    digits = F.transform(bins, lambda x: F.substring(F.hex(x.cast("bigint") + F.lit(3 << KEPT_BITS - 1)), 2, 2))
    return F.coalesce(F.lower(F.array_join(digits, "")), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two texts' shingles, from 0 to 1. Two texts
    without words are alike, one with and one without are not."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    chance = 2.0**-KEPT_BITS
    clean = F.greatest(F.lit(0.0), (same - F.lit(chance)) / F.lit(1.0 - chance))
    return (
        F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(clean)
    )


def next_ids(ids: DataFrame, bits: int = 10) -> DataFrame:
    """``id``, ``next_id`` for a table of different integers: each one's successor,
    null for the largest. Works on blocks of at most 2**bits ids and, for the
    last of a block, on the blocks themselves in the same way."""
    lo, hi = ids.agg(F.min("id"), F.max("id")).first()
    if lo is None:
        return ids.select("id", F.lit(None).cast("bigint").alias("next_id"))
    return _next_ids(ids, lo, hi, bits)


def _next_ids(ids: DataFrame, lo: int, hi: int, bits: int) -> DataFrame:
    if hi - lo < 1 << bits:  # at most 2**bits ids
        return ids.select("id", F.lead("id").over(Window.partitionBy(F.lit(0)).orderBy("id")).alias("next_id"))
    blocked = ids.select("id", F.shiftright("id", bits).alias("block"))
    within = Window.partitionBy("block").orderBy("id")
    placed = blocked.select("id", "block", F.lead("id").over(within).alias("next_id"))
    # written, as the levels above read it twice each
    firsts = cut_lineage(blocked.groupBy("block").agg(F.min("id").alias("first_id")), "firsts")
    follow = _next_ids(firsts.select(F.col("block").alias("id")), lo >> bits, hi >> bits, bits)
    follow = cut_lineage(follow, "next-blocks")
    after = follow.select(F.col("id").alias("block"), F.col("next_id").alias("then")).join(
        firsts.select(F.col("block").alias("then"), "first_id"), "then"
    )
    joined = placed.join(after.select("block", "first_id"), "block", "left")
    return joined.select("id", F.coalesce("next_id", "first_id").alias("next_id"))


def fingerprint_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints every document and its edited text, and compares them.

    Returns ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. The edited text is the
    text with its last floor(n_chars / 2) code points replaced by the first as
    many of the next document, in ascending id; the first document follows the
    last. Null text is empty. Rows with equal ids stand in the order of a text
    hash. A row with a null id has no place in the order: it gets a
    fingerprint, and nulls for what needs a neighbour. A single document is its
    own neighbour; an empty table gives an empty result. Other columns are
    not read.

    The texts are shuffled once, to blocks of 2**8 ids; the last document of a
    block gets its neighbour from the first ones of the other blocks.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    rows = add_bins(rows, "text", "bins")
    placed = rows.filter(F.col("id").isNotNull()).withColumn("tie", F.xxhash64("text"))
    blocks = placed.withColumn("block", F.shiftright("id", BLOCK_BITS)).repartition("block")
    order = Window.partitionBy("block").orderBy("id", "tie")
    ranked = blocks.select(
        "*",
        F.row_number().over(order).alias("rank"),
        F.lead(F.struct("text", "bins")).over(order).alias("follow"),
    )
    ids = docs.select(F.shiftright(F.col(id_col).cast("bigint"), BLOCK_BITS).alias("id"))
    block_ids = cut_lineage(ids.filter(F.col("id").isNotNull()).distinct(), "blocks")
    first_block = block_ids.agg(F.min("id")).first()[0]
    successor = next_ids(block_ids).select(
        F.col("id").alias("block"),
        F.coalesce("next_id", F.lit(first_block).cast("bigint")).alias("then"),
    )
    heads = ranked.filter("rank = 1").select(F.col("block").alias("then"), F.struct("text", "bins").alias("head"))
    joined = ranked.join(successor.join(heads, "then").select("block", "head"), "block")
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    follow = F.coalesce(F.col("follow"), F.col("head"))
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(follow["text"], F.lit(1), half)
    )
    changed = joined.select(
        "id", n.cast("bigint").alias("n_chars"), "bins", follow["bins"].alias("next_bins"), edited.alias("edited")
    )
    changed = add_bins(changed, "edited", "edited_bins")
    done = changed.select(
        "id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
    loose = rows.filter(F.col("id").isNull()).select(
        "id",
        n.cast("bigint").alias("n_chars"),
        F.lit(None).cast("string").alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"),
        F.lit(None).cast("string").alias("edited_fingerprint"),
        F.lit(None).cast("double").alias("near_edited"),
        F.lit(None).cast("double").alias("near_next"),
    )
    return done.unionByName(loose)


def op4_query(spark: SparkSession, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    return fingerprint_edits(docs).withColumnRenamed("id", "doc_id")
