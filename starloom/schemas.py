"""Target schemas, sentinels and the SCD specification."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed values that must agree with the modelled warehouse.
END_OF_TIME = dt.date(9999, 12, 31)  # open end of the current version's window
UNKNOWN_KEY = -1  # reserved surrogate for a missing or late dimension member
UNKNOWN_LABEL = "Unknown"

MONEY = T.DecimalType(12, 2)
PRICE = T.DecimalType(10, 2)
RATE = T.DecimalType(5, 4)


@dataclass(frozen=True)
class Scd2Spec:
    """Describes one versioned dimension.

    ``natural_key``  business key, stable across versions
    ``tracked``      Type-2 attributes: a change opens a new version
    ``type1``        Type-1 attributes: a change overwrites in place
    ``attributes``   every descriptive column carried on a version row
    ``key``          surrogate key column
    ``type1_scope``  "all" restates every version, "current" only the open one
    """

    natural_key: str
    tracked: tuple[str, ...]
    attributes: tuple[str, ...]
    key: str = "key"
    type1: tuple[str, ...] = field(default_factory=tuple)
    type1_scope: str = "all"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_current: str = "is_current"
    version: str = "version"

    @property
    def housekeeping(self) -> tuple[str, ...]:
        return (self.valid_from, self.valid_to, self.is_current, self.version)

    @property
    def columns(self) -> list[str]:
        return [self.key, self.natural_key, *self.attributes, *self.housekeeping]


CUSTOMER_SPEC = Scd2Spec(
    natural_key="customer_id",
    tracked=("segment", "city", "region"),
    attributes=("first_name", "last_name", "email", "segment", "city", "region"),
    key="customer_key",
)

PRODUCT_SPEC = Scd2Spec(
    natural_key="product_id",
    tracked=("category", "brand"),
    attributes=("product_name", "category", "subcategory", "brand", "unit_price"),
    key="product_key",
)

DIM_DATE = T.StructType(
    [
        T.StructField("date_key", T.IntegerType(), False),
        T.StructField("full_date", T.DateType(), False),
        T.StructField("day_of_month", T.ShortType(), False),
        T.StructField("day_name", T.StringType(), False),
        T.StructField("day_of_week", T.ShortType(), False),
        T.StructField("is_weekend", T.BooleanType(), False),
        T.StructField("month_number", T.ShortType(), False),
        T.StructField("month_name", T.StringType(), False),
        T.StructField("quarter", T.ShortType(), False),
        T.StructField("year", T.ShortType(), False),
        T.StructField("year_month", T.StringType(), False),
    ]
)

STG_SALES = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("line_number", T.IntegerType(), False),
        T.StructField("order_date", T.DateType(), False),
        T.StructField("product_id", T.LongType(), False),
        T.StructField("store_id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("unit_price", PRICE, False),
        T.StructField("discount_pct", RATE, False),
        T.StructField("gross_amount", MONEY, False),
        T.StructField("net_amount", MONEY, False),
    ]
)

FACT_SALES_COLUMNS = [
    "sale_key",
    "order_id",
    "date_key",
    "product_key",
    "store_key",
    "customer_key",
    "quantity",
    "unit_price",
    "discount_pct",
    "gross_amount",
    "net_amount",
]

# Grain of one staged order line.
STG_GRAIN = ("order_id", "line_number", "product_id", "store_id")
# Order of sale_key: the grain, then the measures as tie-breakers, so the
# numbering is reproducible even when an extract repeats a grain key.
SALE_KEY_ORDER = STG_GRAIN + ("quantity", "discount_pct", "gross_amount", "net_amount")
