"""Column helpers shared by the text operators.

A *word* is a run of characters other than the six ASCII white-space
characters, unless an operator says otherwise. Null text counts as empty.
"""

from __future__ import annotations

import string
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def text_of(name: str) -> Column:
    """The text, empty for null; a non-string column is read as its string form."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. All-ASCII texts take the quick built-in, others a
    character table, so no letter outside A-Z changes."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """The text's words in order, as an array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    empty = F.array().cast("array<string>")
    return F.when(trimmed == "", empty).otherwise(F.split(trimmed, SPACE_RUN))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(hashes: Column, n: int) -> Column:
    """Hash of every run of ``n`` array elements, in order; the whole array as
    one run when it is shorter (so an empty array has one run too).

    ``hashes`` has to be a plain column: it is read inside the lambda.
    """
    at = F.sequence(F.lit(0), F.greatest(F.size(hashes) - F.lit(n), F.lit(0)))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + F.lit(j)) for j in range(n)]))


def row_key(*cols: str) -> list[Column]:
    """128 bits that stand for the named columns' values; nulls count as values."""
    named = [F.col(c).cast("string") for c in cols]
    marks = [F.col(c).isNull() for c in cols]
    return [
        F.xxhash64(*named, *marks).alias("key_a"),
        F.xxhash64(F.lit("b"), *marks, *reversed(named)).alias("key_b"),
    ]


KEY = ["key_a", "key_b"]


def pack_row(df: DataFrame, alias: str = "row") -> Column:
    """All columns as one struct, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(alias)
