"""The paths taken when data outgrows the broadcast bound, and hot keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators.asof import lookup_versions
from starloom.plans.compare import compare_one
from starloom.schemas import END_OF_TIME, Scd2Spec

from .conftest import SF_SMALL


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    import starloom.plans.star as star

    monkeypatch.setattr(star, "MAX_BROADCAST_ROWS", -1)
    monkeypatch.setattr(star, "MAX_BROADCAST_DAYS", -1)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["fact_resolve", "segment_pit_vs_current", "category_month", "late_repair"])
def test_shuffle_join_path_gives_the_same_answer(spark, no_broadcast, name):
    r = compare_one(spark, SF_SMALL, name)
    assert r["values_match"], r


def test_shuffle_join_path_plans_no_broadcast(spark, no_broadcast, capsys):
    from starloom.plans.star import build_star

    build_star(spark, SF_SMALL).fact.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_hot_member_is_split_by_adaptive_skew_join(spark, capsys):
    spec = Scd2Spec(natural_key="id", tracked=("seg",), attributes=("seg",), key="k")
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 6, 1)
    dims = [(1, 0, "A", d1, d2, False, 1), (2, 0, "B", d2, END_OF_TIME, True, 2)]
    dims += [(10 + i, i, "A", d1, END_OF_TIME, True, 1) for i in range(1, 2000)]
    dim = spark.createDataFrame(
        dims, "k long, id long, seg string, valid_from date, valid_to date, is_current boolean, version int"
    )
    # member 0 holds a third of all facts
    facts = spark.range(0, 600000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1999 + 1).alias("id"),
        F.date_add(F.lit(d1), (F.col("id") % 300).cast("int")).alias("d"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = lookup_versions(facts, dim, spec, "id", "d")
        got = out.groupBy("k").count().collect()
        assert sum(r["count"] for r in got) == 600000
        hot = {r["k"]: r["count"] for r in got if r["k"] in (1, 2)}
        assert hot[1] + hot[2] == 200000
        agg = out.groupBy("k").count()
        agg.collect()
        agg.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
