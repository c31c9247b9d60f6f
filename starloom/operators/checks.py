"""Data-quality checks T1-T10 and the mixed-grain guard.

Every check returns a small long-form DataFrame ``(metric, value)`` built
from aggregates, so a check is one distributed job whose result is a
handful of rows. :func:`failures` turns expected values into assertions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.schemas import END_OF_TIME, Scd2Spec

VALUE = "decimal(38,2)"


def metric(df: DataFrame, name: str, value: Column) -> DataFrame:
    """One aggregate over ``df`` as a (metric, value) row."""
    return df.agg(value.cast(VALUE).alias("value")).select(F.lit(name).alias("metric"), "value")


def metrics(rows: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, list(rows))


def counted(flags: DataFrame, names: Sequence[str]) -> DataFrame:
    """How often each boolean column holds: one aggregate, a row per column."""
    one = flags.agg(*[F.count_if(F.col(n)).cast(VALUE).alias(n) for n in names])
    return one.unpivot([], list(names), "metric", "value")


def measured(df: DataFrame, **values: Column) -> DataFrame:
    """Several named aggregates over ``df`` in one pass, a (metric, value) row each."""
    one = df.agg(*[v.cast(VALUE).alias(n) for n, v in values.items()])
    return one.unpivot([], list(values), "metric", "value")


TOTAL = "_is_total"


def with_total(fact: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Every row twice, as itself and for the grand total (``_is_total``, its keys
    null). A check then finds both sides in one scan of the fact, and joins that lose
    or double rows change one side only."""
    as_is = F.struct(F.lit(False).alias(TOTAL), *[F.col(k) for k in keys], *[F.col(m) for m in measures])
    none = [F.lit(None).cast(fact.schema[k].dataType).alias(k) for k in keys]
    total = F.struct(F.lit(True).alias(TOTAL), *none, *[F.col(m) for m in measures])
    return fact.select(F.explode(F.array(as_is, total)).alias("r")).select("r.*")


def failures(check: DataFrame, expected: dict[str, object]) -> list[str]:
    got = {r["metric"]: r["value"] for r in check.collect()}
    return [f"{k}: expected {v}, got {got.get(k)}" for k, v in expected.items() if got.get(k) != v]


def count_rows(df: DataFrame, name: str) -> DataFrame:
    return metric(df, name, F.count(F.lit(1)))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of key values held by more than one row (grain / PK check)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return count_rows(dup, name)


def grain(stg: DataFrame, fact: DataFrame, stg_grain: Sequence[str], fact_key: str) -> DataFrame:
    """T1 + D19: one fact row per staged line, no repeated grain key."""
    return metrics(
        [
            count_rows(stg, "staged_lines"),
            count_rows(fact, "fact_lines"),
            duplicate_keys(stg, stg_grain, "duplicate_grain_keys"),
            duplicate_keys(fact, [fact_key], "duplicate_fact_keys"),
        ]
    )


def orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose foreign key has no dimension row, per key.

    One pass over the fact; dimension keys are unique (T8).
    """
    found = fact.select(*dims)
    for key, dim in dims.items():
        known = dim.select(F.col(key).alias(f"_{key}"), F.lit(True).alias(f"_has_{key}"))
        found = found.join(known, F.col(key) == F.col(f"_{key}"), "left")
    missing = found.select(*[F.col(f"_has_{key}").isNull().alias(f"orphan_{key}") for key in dims])
    return counted(missing, [f"orphan_{key}" for key in dims])


def one_current(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Members without exactly one current version."""
    per = dim.groupBy(spec.natural_key).agg(F.count_if(F.col(spec.is_current)).alias("_c"))
    return count_rows(per.where(F.col("_c") != 1), "members_not_one_current")


def tiling(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """T4: windows tile per member (no gap/overlap), only the last is open
    and current, versions count 1, 2, 3, ...

    Each window partition holds one member's versions.
    """
    w = Window.partitionBy(spec.natural_key).orderBy(spec.version)
    nxt = F.lead(spec.valid_from).over(w)
    rn = F.row_number().over(w)
    t = dim.select(
        (nxt.isNotNull() & (F.col(spec.valid_to) != nxt)).alias("gap"),
        (nxt.isNull() & (F.col(spec.valid_to) != F.lit(END_OF_TIME))).alias("last_not_open"),
        (F.col(spec.is_current) != nxt.isNull()).alias("wrong_current"),
        (F.col(spec.valid_from) >= F.col(spec.valid_to)).alias("empty_window"),
        (F.col(spec.version) != rn).alias("version_hole"),
    )
    return counted(t, ("gap", "last_not_open", "wrong_current", "empty_window", "version_hole"))


def multi_version(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Members with more than one version."""
    per = dim.groupBy(spec.natural_key).agg(F.count(F.lit(1)).alias("_n"))
    return count_rows(per.where(F.col("_n") > 1), "members_with_history")


def not_null(df: DataFrame, name: str) -> DataFrame:
    """NULLs in any column, counted for all columns in one pass."""
    return metric(
        df,
        f"{name}_nulls",
        reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns]),
    )


def same_rows(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Rows present on one side only, both directions (multiset)."""
    return metrics(
        [
            count_rows(a.exceptAll(b), f"{name}_missing"),
            count_rows(b.exceptAll(a), f"{name}_extra"),
        ]
    )
