"""Scans of the input tables (Parquet, pruned and filtered by Catalyst)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


@dataclass
class Tables:
    """Lazy handles on the driver's tables; nothing is read until an action."""

    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.root, name)
        raise AttributeError(name)
