"""Predicates shared by the loaders and checks."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_changed(columns: Iterable[str], left: str, right: str) -> Column:
    """True when any of ``columns`` differs between two aliases, NULL-safely.

    NULL versus NULL is "unchanged"; NULL versus a value is a change.
    """
    return any_changed_cols((F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in columns)


def any_changed_cols(pairs: Iterable[tuple[Column, Column]]) -> Column:
    tests = [~a.eqNullSafe(b) for a, b in pairs]
    if not tests:
        return F.lit(False)
    return reduce(lambda a, b: a | b, tests)
