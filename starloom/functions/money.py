"""Money rules: decimals in, explicit result types out, round after aggregating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.columns import as_col as _c
from starloom.schemas import MONEY, PRICE, RATE


def to_money(x: str | Column) -> Column:
    return _c(x).cast(MONEY)


def to_price(x: str | Column) -> Column:
    return _c(x).cast(PRICE)


def to_rate(x: str | Column) -> Column:
    return _c(x).cast(RATE)


def net_of_discount(gross: str | Column, discount: str | Column) -> Column:
    """``gross * (1 - discount)`` evaluated in decimal, stored at two places."""
    return (_c(gross) * (F.lit(1) - _c(discount))).cast(MONEY)


def whole(x: str | Column) -> Column:
    """ROUND(x, 0) half away from zero, as a bigint. Apply to aggregates only."""
    return F.round(_c(x), 0).cast("bigint")


def exact_sum(x: str | Column) -> Column:
    """Sum of a decimal measure, kept at two places with the widest precision
    (a 100 TB fact's grand total does not fit 18 digits)."""
    return F.sum(_c(x)).cast("decimal(38,2)")


def ratio(num: str | Column, den: str | Column) -> Column:
    """Ratio of two aggregates as double, unrounded (both sums are exact)."""
    return _c(num).cast("double") / _c(den).cast("double")
