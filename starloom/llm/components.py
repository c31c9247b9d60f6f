"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_lineage

#: So many links take the room of one document.
NARROW = 16


def components(links: DataFrame, max_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """``node``, ``root`` (the smallest node it reaches) for every linked node.

    ``links`` has integer columns ``a`` and ``b``, and takes the room of about ``rows``
    documents if that is known; loops and repeats are allowed.
    Alternates large-star and small-star: every node hands its larger, then its
    other neighbours to its smallest one, until all hang on their root. The
    rounds grow with the logarithm of the longest chain. Minima are summed up
    before the shuffle, so a node with very many neighbours costs a row a task.
    """
    edges = cut_lineage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
        rows,
    )
    rows = edges.count() // NARROW
    state = None
    for _ in range(max_rounds):
        edges = cut_lineage(_small_star(_large_star(edges)), "links", rows)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state, rows = now, now[0] // NARROW
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).filter("u <> v").distinct()
