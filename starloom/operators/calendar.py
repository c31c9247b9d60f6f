"""S5 calendar dimension and D9 conformed month rollup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_attributes, month_key


def _date(x: dt.date | str | Column) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x if isinstance(x, dt.date) else dt.date.fromisoformat(x)).cast("date")


def _expand(bounds: DataFrame, lo: Column, hi: Column) -> DataFrame:
    days = bounds.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_attributes("d"))


def calendar(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day of the inclusive range [start, end]."""
    one = spark.range(1)
    return _expand(one, _date(start), _date(end))


def month_dimension(dim_date: DataFrame) -> DataFrame:
    """Month grain as a strict attribute subset of the day calendar."""
    return (
        dim_date.groupBy("year_month")
        .agg(
            F.first("year").alias("year"),
            F.first("quarter").alias("quarter"),
            F.first("month_number").alias("month_number"),
            F.first("month_name").alias("month_name"),
            month_key(F.min("full_date")).alias("month_key"),
            F.count(F.lit(1)).cast("int").alias("days_in_month"),
        )
    )
