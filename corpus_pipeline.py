"""Corpus pipeline: quality rules, near-dedup, mixing, packing.

``STAGES`` lists the steps. Each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written and read again as the next one's docs, in files for
as many rows as the docs have. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.minhash_dedup import drop_near_duplicates
from starloom.llm.mixing import take_mix
from starloom.llm.packing import pack_documents
from starloom.llm.quality_rules import keep_documents
from starloom.session import cut_lineage, few_parts


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return few_parts(keep_documents(docs), docs.count())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 0.8)."""
    return few_parts(drop_near_duplicates(docs, k=5, percent=80), docs.count())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their targets: a document stands as often as it is taken."""
    return few_parts(take_mix(docs), docs.count())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every taken document's pieces, placed in token sequences."""
    return few_parts(pack_documents(docs), docs.count()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Hash sketches, near-duplicate search and the tokenizer have no SQL form; the
#: stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
