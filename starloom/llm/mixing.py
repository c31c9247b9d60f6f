"""Mixing sources to target weights by systematic sampling [native].

Every source gets a target number of words; the target over the source's size
is the number of copies expected of each of its documents. The expected copies
are summed up along the source, one random offset is added, and a document is
emitted once for every integer that its step crosses.

Documents of a source stand in the order of their size, so that the emitted
ones are spread evenly over short and long documents and the words taken stay
within about one longest document of the target. The running count is never
made in one task: documents are dealt to cells of (source, size, 12 bits of an
id hash), counted inside the cell, and shifted by the counts of the cells
before (at most 4096 cells of one size, then one row per size of a source).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import pack_row, text_of, words_of
from starloom.session import cut_counted

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"
#: So many cells take the room of one document.
NARROW = 16


def targets(sources: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """One row per source (``source``, ``source_size``) plus its ``target``.

    Sources stand by code point, null last, and weigh ``weights`` in turn. All
    words are shared by weight; a target stops at ``cap`` times its source's
    size and the excess is shared anew among the others. With the sources in
    the order of size / weight those that stop are the first ones, so the share
    per weight unit is read off at the first source that doesn't stop.
    The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.partitionBy(F.lit(1))
    table = F.array(*[F.lit(w) for w in weights])
    weighed = sources.withColumn(
        "weight", F.get(table, (F.row_number().over(by_name) - 1) % F.lit(len(weights)))
    )
    ceiling = F.lit(cap) * F.col("source_size")
    by_room = Window.partitionBy(F.lit(1)).orderBy(
        ceiling / F.col("weight"), F.col("source").isNull(), "source"
    )
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    shared = weighed.select(
        "*",
        F.row_number().over(by_room).alias("place"),
        (
            (total - F.coalesce(F.sum(ceiling).over(before), F.lit(0))).cast("double")
            / F.sum("weight").over(onward).cast("double")
        ).alias("per_weight"),
    )
    fits = F.col("per_weight") * F.col("weight") <= ceiling
    first = F.min(F.when(fits, F.struct("place", "per_weight"))).over(everything)
    share = first["per_weight"] * F.col("weight")
    stop = ceiling.cast("double")
    return shared.select(
        "source", "source_size", F.when(first.isNull(), stop).otherwise(F.least(share, stop)).alias("target")
    )


def offset(source: Column, seed: str) -> Column:
    """The source's one random offset in [0, 1), from 32 bits of a seeded digest."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)


def systematic_mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """``row`` (the document), ``size``, ``source_size``, ``target``, ``copies``.

    One output row per input row; ``copies`` says how often the mix takes it,
    at most ``cap`` times. ``size`` is the number of words of ``text`` unless
    given. Null text has size 0, a null source is a source of its own, a null
    id is a value like any other. Equal rows are separate documents; reruns
    over the same rows give equal copies per (id, source, size). An empty table
    gives an empty result. Columns of any name may ride along in ``row``.
    """
    measured = F.size(words_of(text_of("text"))) if size is None else size
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    source = F.col(source_col).cast("string")
    rows = docs.select(
        pack_row(docs),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("k"),
        F.coalesce(measured, F.lit(0)).cast("bigint").alias("size"),
        digest.alias("h"),
    ).withColumn("block", F.substring("h", 1, 3))

    cells, _ = cut_counted(
        rows.groupBy("k", "size", "block").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source")),
        "mix-cells",
        NARROW,
    )
    sizes = cells.groupBy("k", "size").agg(F.sum("n").alias("n"), F.first("source").alias("source"))
    sources = sizes.groupBy("k").agg(
        F.first("source").alias("source"), F.sum(F.col("n") * F.col("size")).alias("source_size")
    )
    plan = targets(sources.select("source", "source_size"), weights, cap).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("k"), "source_size", "target"
    )
    preceding = (Window.unboundedPreceding, -1)
    size_start = sizes.select(
        "k",
        "size",
        F.coalesce(
            F.sum("n").over(Window.partitionBy("k").orderBy("size").rowsBetween(*preceding)), F.lit(0)
        ).alias("size_start"),
    )
    cell_start = cells.select(
        "k",
        "size",
        "block",
        F.coalesce(
            F.sum("n").over(Window.partitionBy("k", "size").orderBy("block").rowsBetween(*preceding)), F.lit(0)
        ).alias("cell_start"),
    )
    starts = cell_start.join(size_start, ["k", "size"]).join(plan, "k")

    placed = rows.withColumn(
        "in_cell", F.row_number().over(Window.partitionBy("k", "size", "block").orderBy("h"))
    ).join(starts, ["k", "size", "block"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = (F.col("size_start") + F.col("cell_start") + F.col("in_cell")).cast("double")
    start = offset(F.col("source"), seed)
    crossed = F.floor(rate * rank + start) - F.floor(rate * (rank - F.lit(1.0)) + start)
    return placed.select(
        "row",
        "size",
        "source_size",
        "target",
        F.least(crossed, F.lit(cap)).cast("bigint").alias("copies"),
    )


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document's row as often as its copies say."""
    mixed = systematic_mix(docs, **options).filter(F.col("copies") > 0)
    repeated = mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.select("row.*")


def op7_query(spark, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "source", "text")
    slim = docs.select("doc_id", "source", F.size(words_of(text_of("text"))).cast("bigint").alias("size"))
    mixed = systematic_mix(slim, size=F.col("size"))
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


OP7_SQL = """
with d as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as h,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size
  from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size from d group by source
), w as (
  select *, 1 + (row_number() over (order by source is null, source) - 1) % 3 as weight,
         cast(sum(source_size) over () as bigint) as total
  from s
), p as (
  select *, row_number() over room as place,
         cast(total - coalesce(sum(3 * source_size) over (room rows between unbounded preceding and 1 preceding), 0)
              as double)
         / cast(sum(weight) over (room rows between current row and unbounded following) as double) as per_weight
  from w
  window room as (order by 3 * source_size / weight, source is null, source)
), f as (
  select per_weight from p where per_weight * weight <= 3 * source_size order by place limit 1
), t as (
  select source, source_size, least((select per_weight from f) * weight, cast(3 * source_size as double)) as target,
         cast(cast('0x' || substr(md5('mix-1' || coalesce('=' || source, '')), 1, 8) as bigint) as double)
         / 4294967296.0 as u
  from p
), r as (
  select d.doc_id, d.size, t.source_size, t.target, t.u,
         case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
         cast(row_number() over (partition by d.source order by d.size, d.h) as double) as rank
  from d join t on d.source is not distinct from t.source
)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(least(floor(rate * rank + u) - floor(rate * (rank - 1.0) + u), 3) as bigint) * size as taken
from r
"""
