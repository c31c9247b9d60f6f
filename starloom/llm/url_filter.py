"""URL filter: prefix rules, then a Bloom filter cascade [native].

The cascade answers "is this key on the list?" exactly for every key of the
corpus. Level 0 encodes the listed keys. Level 1 encodes the corpus's unlisted
keys that level 0 lets through by mistake, level 2 the listed keys that level 1
lets through, and so on until no mistake is left. A key's answer is read off at
the first level that does not hold it. Nothing is joined with the list.

A level is an array of 64-bit words for each of ``segments`` equal parts of
the key space (a key's part comes from its hash), so that no array grows
without bound. The levels are one table, a row per part; rows meet it by the
part's number and read bits where they lie in its arrays. Up to ``literal_bytes``
of arrays are broadcast; above that the rows are shuffled to their parts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import lower_ascii
from starloom.session import cut_lineage

BITS_PER_KEY = 10
HASHES = 5
KEYS_PER_SEGMENT = 1 << 16
LITERAL_BYTES = 4 << 20

# (host, path, verdict); the longest rule that fits decides.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that fits (host and path as one string) and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


@dataclass
class Cascade:
    """``table``: one row per segment (``segment``, ``words_0``, ``words_1``, ...: its words in each level)."""

    segments: int
    hashes: int
    literal_bytes: int
    table: DataFrame | None = None
    widths: list[int] = field(default_factory=list)

    def segment(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.segments)).cast("int")

    def positions(self, key: Column, level: int, width: int) -> list[Column]:
        return [
            F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(64 * width).cast("bigint"))
            for j in range(self.hashes)
        ]

    def _holds(self, key: Column, level: int, words: Column) -> Column:
        held = F.lit(True)
        for p in self.positions(key, level, self.widths[level]):
            word = F.get(words, F.shiftright(p, 6).cast("int"))
            held = held & (F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return held

    def attach(self, rows: DataFrame, key: Column) -> DataFrame:
        """Rows plus column ``held``: per level so far, whether it holds the key."""
        small = 8 * self.segments * sum(self.widths) <= self.literal_bytes
        out = rows.withColumn("segment", self.segment(key)).join(
            F.broadcast(self.table) if small else self.table, "segment"
        )
        words = [f"words_{level}" for level in range(len(self.widths))]
        held = [self._holds(key, level, F.col(w)) for level, w in enumerate(words)]
        return out.withColumn("held", F.array(*held)).drop("segment", *words)

    def listed(self) -> Column:
        """From ``held``: the answer at the first level that does not hold the key."""
        n = len(self.widths)
        stop = F.array_position(F.col("held"), F.lit(False)) - 1
        stop = F.when(stop < 0, F.lit(n)).otherwise(stop)
        return stop % 2 == 1


def build_cascade(
    universe: DataFrame,
    *,
    bits_per_key: int = BITS_PER_KEY,
    hashes: int = HASHES,
    keys_per_segment: int = KEYS_PER_SEGMENT,
    literal_bytes: int = LITERAL_BYTES,
    max_levels: int = 64,
) -> Cascade:
    """Builds the cascade from ``universe`` (``key`` string, ``listed`` boolean).

    The universe must hold every key that will be asked, once each; that is what
    makes the answers exact. An empty list needs no level: nothing is listed.
    The number of levels grows with the logarithm of the universe.
    """
    spark = universe.sparkSession
    sides = {
        r["listed"]: r["n"] for r in universe.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    n_listed = sides.get(True, 0)
    segments = max(1, math.ceil(n_listed / keys_per_segment))
    cascade = Cascade(segments, hashes, literal_bytes)
    if not n_listed:
        return cascade
    for level in range(max_levels):
        mine = universe.filter(F.col("listed") == F.lit(level % 2 == 0))
        if level:
            # passed every earlier level of the other parity: mistakes so far
            passed = F.lit(True)
            for i in range(1 - level % 2, level, 2):
                passed = passed & F.get("held", F.lit(i))
            mine = cascade.attach(mine, F.col("key")).filter(passed).select("key")
        per_part = mine.groupBy(cascade.segment(F.col("key")).alias("segment")).count()
        most = per_part.agg(F.max("count")).first()[0]
        if not most:
            return cascade
        width = max(1, math.ceil(most * bits_per_key / 64))
        at = F.explode(F.array(*cascade.positions(F.col("key"), level, width))).alias("p")
        bits = mine.select(cascade.segment(F.col("key")).alias("segment"), at).select(
            "segment",
            F.shiftright("p", 6).alias("word"),
            F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bits"),
        )
        blank = spark.range(segments * width).select(
            F.expr(f"cast(id div {width} as int)").alias("segment"),
            F.expr(f"id % {width}").alias("word"),
            F.lit(0).cast("bigint").alias("bits"),
        )
        words = bits.unionByName(blank).groupBy("segment", "word").agg(F.bit_or("bits").alias("bits"))
        packed = words.groupBy("segment").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias(
                f"words_{level}"
            )
        )
        cascade.widths.append(width)
        table = packed if level == 0 else cascade.table.join(packed, "segment")
        # 256 words are about one document
        cascade.table = cut_lineage(table, "cascade", segments * sum(cascade.widths) // 256)
    raise RuntimeError(f"the cascade did not end in {max_levels} levels")


def filter_urls(
    pages: DataFrame, listed: DataFrame, *, url_col: str = "url", rules=RULES, **options
) -> DataFrame:
    """``row`` (the page), ``host``, ``path``, ``rule``, ``verdict``.

    ``listed`` has the listed keys (``key``: host and path as one string). A
    null url, or one without ``://``, has empty host and path; its key is the
    empty string, and null keys on the list are ignored. Where no rule fits,
    the verdict is ``block`` for a listed key, else ``allow``. Repeated rows get
    equal verdicts; an empty table or list is allowed.
    """
    split = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    ).withColumn("key", F.concat("host", "path"))
    universe = cut_lineage(
        split.select("key", F.lit(False).alias("on_list"))
        .unionByName(
            listed.filter(F.col("key").isNotNull()).select("key", F.lit(True).alias("on_list"))
        )
        .groupBy("key")
        .agg(F.bool_or("on_list").alias("listed")),
        "url-keys",
    )
    cascade = build_cascade(universe, **options)
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    if cascade.widths:
        asked = cascade.attach(split, F.col("key"))
        answer = F.when(cascade.listed(), F.lit("block")).otherwise(F.lit("allow"))
    else:
        asked, answer = split, F.lit("allow")
    return asked.select(
        "row", "host", "path", rule.alias("rule"), F.coalesce(verdict, answer).alias("verdict")
    )


def campaign_keys(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A list that the corpus itself gives: addresses that some page row reaches
    through a campaign link (``utm_source`` in its query)."""
    url = F.col(url_col)
    return pages.filter(url.rlike(r"\?[^#]*utm_source=")).select(
        F.concat(host_of(url), path_of(url)).alias("key")
    )


def op5_query(spark: SparkSession, root: str) -> DataFrame:
    pages = spark.read.parquet(f"{root}/pages.parquet").select("page_id", "url")
    judged = filter_urls(pages, campaign_keys(pages))
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


OP5_SQL = """
with a as (
  select page_id, url,
         case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), b as (
  select page_id, url,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from a
), rules(h, p, v) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best as (
  select page_id, host, path, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as v
  from b join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by page_id, host, path
), listed as (
  select distinct host || path as key from b where regexp_matches(url, '\\?[^#]*utm_source=')
)
select b.page_id, b.host, b.path, best.rule,
       coalesce(best.v, case when b.host || b.path in (select key from listed) then 'block' else 'allow' end) as verdict
from b left join best on b.page_id is not distinct from best.page_id and b.host = best.host and b.path = best.path
"""
