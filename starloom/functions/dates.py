"""Calendar expressions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.columns import as_col as _c


def date_key(d: str | Column) -> Column:
    """Smart integer key YYYYMMDD."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(d: str | Column) -> Column:
    """YYYYMM, the partition grain of the fact (days give tiny files)."""
    d = _c(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def iso_day_of_week(d: str | Column) -> Column:
    """1 = Monday ... 7 = Sunday (``dayofweek`` would put Sunday first)."""
    return (F.weekday(_c(d)) + 1).cast("short")


def day_name(d: str | Column) -> Column:
    """Full English day name, e.g. ``Sunday``."""
    return F.date_format(_c(d), "EEEE")


def month_name(d: str | Column) -> Column:
    """Full English month name, e.g. ``January``."""
    return F.date_format(_c(d), "MMMM")


def year_month(d: str | Column) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def calendar_attributes(d: str | Column) -> list[Column]:
    """Every dim_date column derived from one date column."""
    d = _c(d)
    dow = iso_day_of_week(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).cast("short").alias("day_of_month"),
        day_name(d).alias("day_name"),
        dow.alias("day_of_week"),
        (dow >= 6).alias("is_weekend"),
        F.month(d).cast("short").alias("month_number"),
        month_name(d).alias("month_name"),
        F.quarter(d).cast("short").alias("quarter"),
        F.year(d).cast("short").alias("year"),
        year_month(d).alias("year_month"),
    ]
