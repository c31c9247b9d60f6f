"""Conformed dimensions: D8 drill-across, D10 conformance check, D11 one
attribute reached two ways, D20 snowflake/flatten, D21 outrigger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import assign_dense_keys


def drill_across(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Align separately aggregated facts on shared attributes.

    Each side must already be aggregated to ``on``; the facts themselves are
    never joined to each other. Full outer, so a member on one side survives.
    """
    l, r = left.alias("l"), right.alias("r")
    cond = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on]
    j = l.join(r, cond, "full_outer")
    keys = [F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c) for c in on]
    rest = [F.col(f"l.{c}") for c in left.columns if c not in on] + [
        F.col(f"r.{c}") for c in right.columns if c not in on
    ]
    return j.select(*keys, *rest)


def conformance(a: DataFrame, b: DataFrame, key: str, attr: str, a_name: str, b_name: str) -> DataFrame:
    """Same ``key`` must carry the same ``attr`` in both dimensions.

    Distinct (key, attr) pairs per side (a shuffle of distinct pairs only),
    full outer on key, then a status per key.
    """
    here = F.lit(True)
    pa = a.select(F.col(key).alias("_ka"), F.col(attr).alias(f"{a_name}_{attr}"), here.alias("_in_a")).distinct()
    pb = b.select(F.col(key).alias("_kb"), F.col(attr).alias(f"{b_name}_{attr}"), here.alias("_in_b")).distinct()
    j = pa.join(pb, F.col("_ka").eqNullSafe(F.col("_kb")), "full_outer")
    av, bv = F.col(f"{a_name}_{attr}"), F.col(f"{b_name}_{attr}")
    status = (
        F.when(F.col("_in_a").isNull(), f"{b_name}_only")
        .when(F.col("_in_b").isNull(), f"{a_name}_only")
        .when(av.eqNullSafe(bv), "conformed")
        .otherwise("conflict")
    )
    return j.select(F.coalesce("_ka", "_kb").alias(key), av, bv, status.alias("status"))


def snowflake(dim: DataFrame, branch: Sequence[str], branch_key: str) -> tuple[DataFrame, DataFrame]:
    """Move ``branch`` attributes into their own keyed table.

    Returns (branch table, dimension with ``branch_key`` instead of the
    branch attributes). Branch keys are dense in attribute order.
    """
    sub = assign_dense_keys(dim.select(*branch).distinct(), list(branch), branch_key)
    slim = dim.join(sub, list(branch)).select(
        *[c for c in dim.columns if c not in branch], branch_key
    )
    return sub.select(branch_key, *branch), slim


def flatten(slim: DataFrame, sub: DataFrame, branch_key: str, columns: Sequence[str]) -> DataFrame:
    """D20 inverse: join the branch back and restore the star's columns."""
    return slim.join(sub, branch_key).select(*columns)


def outrigger(dim: DataFrame, date_col: str, dim_date: DataFrame, attrs: Sequence[str], prefix: str) -> DataFrame:
    """Describe a dimension's own date through the shared calendar."""
    cal = dim_date.select(
        F.col("full_date").alias("_o_date"), *[F.col(a).alias(f"{prefix}{a}") for a in attrs]
    )  # pass the calendar broadcast-hinted: many rows share one date
    return dim.join(cal, F.col(date_col) == F.col("_o_date"), "left").drop("_o_date")
