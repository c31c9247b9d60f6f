"""Point-in-time surrogate-key lookup against a versioned dimension.

The join is an equi-join on the natural key with the half-open window
``valid_from <= event_date < valid_to`` as a residual condition, so Spark
plans a hash or sort-merge join (never a nested loop). Broadcast is left to
Spark's size checks (static statistics and AQE's runtime conversion); beyond
the threshold the dimension is shuffled on the natural key, and AQE splits a
hot member's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.schemas import UNKNOWN_KEY, Scd2Spec


def lookup_versions(
    facts: DataFrame,
    dim: DataFrame,
    spec: Scd2Spec,
    fact_key: str,
    event_date: str,
    mode: str = "inner",
    out_col: str | None = None,
    broadcast: bool = False,
) -> DataFrame:
    """Append the key of the version in force on ``event_date``.

    ``mode="inner"`` drops facts without a version (parity load);
    ``mode="unknown"`` keeps them with the reserved key -1.
    ``broadcast`` is for callers that have checked the dimension's size.
    """
    out_col = out_col or spec.key
    versions = dim.select(
        F.col(spec.natural_key).alias("_pit_nk"),
        F.col(spec.valid_from).alias("_pit_from"),
        F.col(spec.valid_to).alias("_pit_to"),
        F.col(spec.key).alias("_pit_key"),
    )
    if broadcast:
        versions = F.broadcast(versions)
    cond = (
        (F.col(fact_key) == F.col("_pit_nk"))
        & (F.col(event_date) >= F.col("_pit_from"))
        & (F.col(event_date) < F.col("_pit_to"))
    )
    how = "inner" if mode == "inner" else "left"
    joined = facts.join(versions, cond, how)
    key = F.col("_pit_key") if mode == "inner" else F.coalesce("_pit_key", F.lit(UNKNOWN_KEY).cast("long"))
    return joined.select(*[F.col(c) for c in facts.columns], key.alias(out_col))


def lookup_key(
    facts: DataFrame,
    dim: DataFrame,
    natural_key: str,
    fact_key: str,
    key: str,
    mode: str = "inner",
    broadcast: bool = False,
) -> DataFrame:
    """Plain natural-key -> surrogate-key lookup (Type-1 / static dims)."""
    keys = dim.select(F.col(natural_key).alias("_lk_nk"), F.col(key).alias("_lk_key"))
    if broadcast:
        keys = F.broadcast(keys)
    how = "inner" if mode == "inner" else "left"
    joined = facts.join(keys, F.col(fact_key) == F.col("_lk_nk"), how)
    k = F.col("_lk_key") if mode == "inner" else F.coalesce("_lk_key", F.lit(UNKNOWN_KEY).cast("long"))
    return joined.select(*[F.col(c) for c in facts.columns], k.alias(key))


def unknown_member_row(dim: DataFrame, spec: Scd2Spec | None, key: str) -> DataFrame:
    """D4 seed row: key -1, text attributes 'Unknown', open window."""
    from starloom.schemas import END_OF_TIME, UNKNOWN_LABEL

    cols = []
    for f in dim.schema.fields:
        if f.name == key:
            cols.append(F.lit(UNKNOWN_KEY).cast(f.dataType).alias(f.name))
        elif spec is not None and f.name == spec.valid_from:
            cols.append(F.lit("0001-01-01").cast("date").alias(f.name))
        elif spec is not None and f.name == spec.valid_to:
            cols.append(F.lit(END_OF_TIME).cast("date").alias(f.name))
        elif spec is not None and f.name == spec.is_current:
            cols.append(F.lit(True).alias(f.name))
        elif spec is not None and f.name == spec.version:
            cols.append(F.lit(0).cast("int").alias(f.name))
        elif f.dataType.typeName() == "string":
            cols.append(F.lit(UNKNOWN_LABEL).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return dim.sparkSession.range(1).select(*cols)


def with_unknown_member(dim: DataFrame, spec: Scd2Spec | None, key: str) -> DataFrame:
    return dim.unionByName(unknown_member_row(dim, spec, key))
