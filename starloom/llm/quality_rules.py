"""Quality rules: per-document counts and cross-document line frequency [native].

Lines are normalised and hashed, and for every host the documents that carry a
line are counted. A line above its host's limit is boilerplate and is taken
out; a document that has too little left is depleted and rejected.

Copies of one document are one document for this count: a line's documents
are told apart by two sketches of a document (the smallest of two digests over
its lines), and the larger of the two numbers of different sketches counts. So
a text that was copied a thousand times does not make its own lines
boilerplate, while a line that stands in many different documents is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import (
    KEY,
    SPACE_RUN,
    SPACES,
    lower_ascii,
    pack_row,
    row_key,
    text_of,
    windows,
    word_hashes,
    words_of,
)
from starloom.session import cut_lineage

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A line is boilerplate in more documents of a host than both of these say.
LINE_DOCS = 20
LINE_SHARE = 0.02
#: A document is depleted with fewer words, or a smaller part of its words, left.
LEFT_WORDS = 10
LEFT_SHARE = 0.2


def _lines(text: Column) -> Column:
    """The text's lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def _normal(line: Column) -> Column:
    return F.regexp_replace(F.btrim(line, F.lit(SPACES)), SPACE_RUN, " ")


def _normal_lines(text: Column) -> Column:
    return F.transform(_lines(lower_ascii(text)), _normal)


def base_counts(rows: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    t = F.col(text)
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    out = rows.withColumns({"_w": words_of(t), "_lines": _lines(t), "n_symbols": symbols.cast("bigint")})
    out = out.withColumns(
        {
            "n_words": F.size("_w").cast("bigint"),
            "word_chars": F.length(F.array_join("_w", "")).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_h": word_hashes(F.col("_w")),
        }
    ).drop("_w", "_lines")
    out = out.withColumn("_win", F.when(F.size("_h") >= WINDOW, windows(F.col("_h"), WINDOW))).drop("_h")
    # (window, place), sorted, for the documents that repeat a window at all
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    pairs = F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    out = out.withColumn("_s", F.when(repeats, pairs)).drop("_win")
    s = F.col("_s")
    twice = F.filter(
        s,
        lambda e, i: (F.coalesce(F.get(s, i - 1)["x"] == e["x"], F.lit(False)))
        | (F.coalesce(F.get(s, i + 1)["x"] == e["x"], F.lit(False))),
    )
    places = F.sort_array(F.transform(twice, lambda e: e["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_s")


def line_table(rows: DataFrame) -> DataFrame:
    """Every document's key, host, line hashes (``lines``) with their word counts
    (``sizes``), and its two sketches ``a`` and ``b``; written once, so that texts are
    cut into lines and normalised once only."""
    lines = rows.select(*KEY, "host", _normal_lines(F.col("text")).alias("x"))
    found = lines.select(
        *KEY,
        "host",
        F.transform("x", lambda x: F.xxhash64(x)).alias("lines"),
        F.transform("x", lambda x: F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("sizes"),
        *[F.array_min(F.transform("x", lambda x, s=s: F.md5(F.concat(F.lit(s), x)))).alias(s) for s in "ab"],
    )
    return cut_lineage(found, "lines")


def boilerplate(lines: DataFrame, *, line_docs: int, line_share: float) -> DataFrame:
    """``host``, ``line`` (hash) of the lines above their host's limit, from the
    :func:`line_table`.

    A first count over all lines, with repeats inside a document left out, is an
    upper bound; only lines above the limit by it are counted by sketches. Either
    count is summed before it is shuffled, so a line that a third of all
    documents carry costs one row a task.
    """
    limits = lines.groupBy("host").agg(
        F.greatest(F.lit(float(line_docs)), F.count(F.lit(1)) * F.lit(line_share)).alias("limit")
    )
    line = F.explode(F.array_distinct("lines")).alias("line")
    often = (
        lines.select("host", line)
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > line_docs)
        .join(limits, "host")
        .filter(F.col("n") > F.col("limit"))
    )
    counted = (
        lines.select("host", "a", "b", line)
        .join(often.select("host", "line", "limit"), ["host", "line"])
        .select("host", "line", "limit", F.explode(F.array(F.concat(F.lit("a"), "a"), F.concat(F.lit("b"), "b"))).alias("s"))
        .distinct()
        .groupBy("host", "line", "limit", F.substring("s", 1, 1))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.filter(F.col("n") > F.col("limit")).select("host", "line").distinct()


def judge_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    host_col: str = "source",
    text_col: str = "text",
    line_docs: int = LINE_DOCS,
    line_share: float = LINE_SHARE,
    left_words: int = LEFT_WORDS,
    left_share: float = LEFT_SHARE,
) -> DataFrame:
    """One row per document: ``key_a``, ``key_b``, ``id``, the base counts,
    ``n_removed_words``, ``base_failed``, ``kept``.

    ``n_removed_words`` counts the words in boilerplate lines. Null text is
    empty and fails the base rules; a null host is a host of its own; a null id
    is a value like any other. Repeated rows are judged alike. An empty
    table gives an empty result. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")).alias("host"),
        text_of(text_col).alias("text"),
        *row_key(id_col, host_col, text_col),
    )
    lines = line_table(rows)
    removed = boilerplate(lines, line_docs=line_docs, line_share=line_share)
    spent = (
        lines.select(*KEY, "host", F.explode(F.arrays_zip("lines", "sizes")).alias("x"))
        .select(*KEY, "host", F.col("x.lines").alias("line"), F.col("x.sizes").alias("n"))
        .join(removed, ["host", "line"], "left_semi")
        .groupBy(*KEY)
        .agg(F.sum("n").alias("n_removed_words"), F.count(F.lit(1)).alias("m"))
    )
    copies = Window.partitionBy(*KEY)
    counted = base_counts(rows, "text").drop("text", "host")
    counted = counted.withColumn("_copies", F.count(F.lit(1)).over(copies))
    judged = counted.join(spent, KEY, "left").withColumn(
        # equal rows have added their words to one sum
        "n_removed_words",
        F.coalesce(F.expr("n_removed_words div _copies"), F.lit(0)).cast("bigint"),
    )
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    depleted = (left < left_words) | (left < F.lit(left_share) * F.col("n_words"))
    return judged.drop("m", "_copies").withColumns(
        {"base_failed": failed, "kept": ~failed & ~(depleted & (F.col("n_removed_words") > 0))}
    )


def keep_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with their own columns only."""
    id_col, host_col = options.get("id_col", "doc_id"), options.get("host_col", "source")
    rejected = judge_documents(docs, **options).filter(~F.col("kept")).select(*KEY).distinct()
    packed = docs.select(pack_row(docs), *row_key(id_col, host_col, options.get("text_col", "text")))
    return packed.join(rejected, KEY, "left_anti").select("row.*")


def op10_query(spark: SparkSession, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "source", "text")
    return judge_documents(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


OP10_SQL = """
with d as (
  select row_number() over () as r, doc_id, coalesce('=' || source, '') as host, coalesce(text, '') as text
  from documents
), w as (
  select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from d
), grams as (
  select r, i, array_to_string(words[i:i + 4], ' ') as g
  from (select r, words, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5)
), hit as (
  select r, i from (select r, i, count(*) over (partition by r, g) as c from grams) where c > 1
), rep as (
  select r, cast(sum(least(5, i - before)) as bigint) as n_repeat_words
  from (select r, i, coalesce(lag(i) over (partition by r order by i), -10) as before from hit) group by r
), normal as (
  select r, host, trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[\\x20\\x09-\\x0D]+', ' ', 'g')) as line
  from (select r, host, unnest(lines) as x from w)
), sketch as (
  select r, min(md5('a' || line)) as a, min(md5('b' || line)) as b from normal group by r
), docs_of as (
  select host, greatest(cast(20 as double), cast(0.02 as double) * count(*)) as lim from d group by host
), common as (
  select n.host, n.line from normal n join sketch using (r) join docs_of using (host)
  group by n.host, n.line, lim
  having greatest(count(distinct a), count(distinct b)) > lim
), gone as (
  select r, sum(len(string_split(line, ' '))) as n from normal join common using (host, line) group by r
), j as (
  select doc_id, cast(len(words) as bigint) as n_words,
         cast(length(array_to_string(words, '')) as bigint) as word_chars,
         cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(gone.n, 0) as n_gone
  from w left join rep using (r) left join gone using (r)
), f as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from j
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (n_gone > 0 and (n_words - n_gone < 10 or n_words - n_gone < cast(0.2 as double) * n_words)) as kept
from f
"""
