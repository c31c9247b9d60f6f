"""Column-argument helper shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
