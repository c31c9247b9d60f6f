"""Measures and derived attributes: D12 ratio of sums, D13 slice discount,
D15 semi-additive balances, D22 decoded codes, D23 bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.money import ratio
from starloom.schemas import UNKNOWN_LABEL


def ratio_of_sums(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """Average net price per unit as SUM(net)/SUM(qty), never AVG(price).

    The naive average list price is shown beside it for comparison.
    """
    return lines.groupBy(*by).agg(
        ratio(F.sum("net_amount"), F.sum("quantity")).alias("net_per_unit"),
        ratio(F.sum("unit_price"), F.count(F.lit(1))).alias("avg_list_price"),
        F.sum("quantity").cast("bigint").alias("units"),
    )


def slice_discount(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """Effective discount of a slice, 1 - SUM(net)/SUM(gross), and the
    unweighted line average for comparison."""
    return lines.groupBy(*by).agg(
        (F.lit(1.0) - ratio(F.sum("net_amount"), F.sum("gross_amount"))).alias("effective_discount"),
        ratio(F.sum("discount_pct"), F.count(F.lit(1))).alias("avg_line_discount"),
        F.count(F.lit(1)).alias("order_lines"),
    )


def period_end_balance(snapshot: DataFrame, date_col: str, period: Column, period_name: str) -> DataFrame:
    """Sum balances across entities on each day, then take the value at
    the period's last day (never sum a balance over time)."""
    daily = snapshot.groupBy(date_col).agg(
        F.sum("balance").cast("decimal(38,2)").alias("total_balance"),
        F.count(F.lit(1)).alias("entities"),
    )
    return daily.groupBy(period.alias(period_name)).agg(
        F.max(date_col).alias("period_end"),
        F.max_by("total_balance", date_col).alias("closing_balance"),
        F.max_by("entities", date_col).alias("entities"),
    )


def decode(col: str | Column, codes: Mapping[str, str], default: str = UNKNOWN_LABEL) -> Column:
    """Code -> label through an in-expression map; unknown codes get
    ``default``. No join, evaluated inside whole-stage codegen."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], F.lit(default))


def band(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Precomputed band; ``labels[i]`` for values below ``edges[i]``,
    the last label for the rest. Thresholds are parameters."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = F.col(col) if isinstance(col, str) else col
    out = F.when(c < F.lit(edges[0]), labels[0])
    for e, lab in zip(edges[1:], labels[1:-1]):
        out = out.when(c < F.lit(e), lab)
    return out.otherwise(labels[-1])
