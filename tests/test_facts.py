"""Fact resolution, unknown member, late repair and snapshot facts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from starloom.operators import checks as C
from starloom.operators.asof import lookup_versions, with_unknown_member
from starloom.operators.facts import (
    accumulate,
    accumulating_snapshot,
    latest_per_merge_key,
    periodic_snapshot,
    repair_late_members,
)
from starloom.schemas import END_OF_TIME, UNKNOWN_KEY, Scd2Spec

SPEC = Scd2Spec(natural_key="id", tracked=("seg",), attributes=("seg",), key="k")
D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 6, 1)


def dim(spark, rows):
    return spark.createDataFrame(
        rows, "k long, id int, seg string, valid_from date, valid_to date, is_current boolean, version int"
    )


TWO_VERSIONS = [(1, 7, "A", D1, D2, False, 1), (2, 7, "B", D2, END_OF_TIME, True, 2)]


def test_fact_on_boundary_takes_the_new_version(spark):
    facts = spark.createDataFrame([(7, D2), (7, D2 - dt.timedelta(days=1))], "id int, d date")
    out = lookup_versions(facts, dim(spark, TWO_VERSIONS), SPEC, "id", "d")
    assert sorted((r["d"], r["k"]) for r in out.collect()) == [(D2 - dt.timedelta(days=1), 1), (D2, 2)]


def test_fact_before_first_version_inner_drops_unknown_keeps(spark):
    facts = spark.createDataFrame([(7, dt.date(2019, 5, 5)), (8, D2)], "id int, d date")
    d = dim(spark, TWO_VERSIONS)
    assert lookup_versions(facts, d, SPEC, "id", "d", "inner").count() == 0
    keys = [r["k"] for r in lookup_versions(facts, d, SPEC, "id", "d", "unknown").collect()]
    assert keys == [UNKNOWN_KEY, UNKNOWN_KEY]


def test_unknown_member_row(spark):
    d = with_unknown_member(dim(spark, TWO_VERSIONS), SPEC, "k")
    row = d.where(F.col("k") == UNKNOWN_KEY).first()
    assert row["seg"] == "Unknown" and row["is_current"] and row["valid_to"] == END_OF_TIME


def test_overlap_is_caught_by_tiling_and_doubles_a_fact(spark):
    bad = dim(spark, [(1, 7, "A", D1, END_OF_TIME, True, 1), (2, 7, "B", D2, END_OF_TIME, True, 2)])
    got = {r["metric"]: r["value"] for r in C.tiling(bad, SPEC).collect()}
    assert got["gap"] > 0
    facts = spark.createDataFrame([(7, dt.date(2020, 7, 1))], "id int, d date")
    assert lookup_versions(facts, bad, SPEC, "id", "d").count() == 2  # what T1 would flag


def test_late_member_repair(spark):
    d = dim(spark, [(5, 7, "A", D2, END_OF_TIME, True, 1)])  # member first known from D2
    lines = spark.createDataFrame(
        [(1, 7, dt.date(2020, 3, 3), UNKNOWN_KEY), (2, 7, dt.date(2020, 7, 7), 5), (3, 9, D1, UNKNOWN_KEY)],
        "line int, id int, d date, k long",
    )
    out = repair_late_members(lines, d, SPEC, "id", "d")
    assert sorted((r["line"], r["k"]) for r in out.collect()) == [(1, 5), (2, 5), (3, UNKNOWN_KEY)]


def test_latest_per_merge_key(spark):
    b = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "id int, v string, batch int")
    got = sorted(tuple(r) for r in latest_per_merge_key(b, ["id"], "batch").collect())
    assert got == [(1, "y"), (2, "z")]


def test_accumulate_equals_single_pass(spark):
    rnd = random.Random(5)
    rows = []
    for o in range(200):
        od = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 300))
        for _ in range(rnd.randint(1, 5)):
            rows.append((o, od, od + dt.timedelta(days=rnd.randint(0, 90))))
    ships = spark.createDataFrame(rows, "order_id int, order_date date, ship_date date")
    cut = F.lit(dt.date(2020, 6, 1))
    two = accumulate(
        accumulating_snapshot(ships.where(F.col("ship_date") < cut)),
        accumulating_snapshot(ships.where(F.col("ship_date") >= cut)),
    )
    one = accumulating_snapshot(ships)
    assert two.exceptAll(one).count() == 0 and one.exceptAll(two).count() == 0


def test_periodic_snapshot_against_brute_force_with_a_hot_user(spark):
    rnd = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        user = 1 if i % 3 == 0 else rnd.randint(2, 30)  # user 1 holds a third of all events
        ts = start + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        rows.append((i, ts, user, round(rnd.uniform(-5, 20), 2)))
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double")
    end = dt.date(2024, 1, 21)
    got = {(r["user_id"], r["snapshot_date"]): r["balance"] for r in periodic_snapshot(ev, "user_id", "ts", "value", end).collect()}
    # brute force: running balance per user per day
    from decimal import Decimal

    per = {}
    for _, ts, u, v in rows:
        per.setdefault(u, []).append((ts.date(), Decimal(str(v))))
    want = {}
    for u, items in per.items():
        first = min(d for d, _ in items)
        d = first
        while d <= end:
            want[(u, d)] = sum((v for dd, v in items if dd <= d), Decimal("0"))
            d += dt.timedelta(days=1)
    assert got.keys() == want.keys()
    assert all(got[k] == want[k] for k in want)


def test_type1_restatement_applies_null_corrections(spark):
    from starloom.operators.scd import restate_type1

    spec = Scd2Spec(natural_key="id", tracked=("seg",), attributes=("seg", "email"), key="k")
    d = spark.createDataFrame(
        [(1, 7, "A", "old@x", D1, D2, False, 1), (2, 7, "B", "old@x", D2, END_OF_TIME, True, 2)],
        "k long, id int, seg string, email string, valid_from date, valid_to date, is_current boolean, version int",
    )
    fix = spark.createDataFrame([(7, None)], "id int, email string")
    out = restate_type1(d, fix, spec, ("email",))
    assert [r["email"] for r in out.collect()] == [None, None]


def test_null_merge_keys_survive(spark):
    b = spark.createDataFrame([(None, 1, "old"), (None, 2, "new"), (2, 1, "x")], "id int, batch int, v string")
    got = {(r["id"], r["v"]) for r in latest_per_merge_key(b, ["id"], "batch").collect()}
    assert got == {(None, "new"), (2, "x")}


def test_periodic_snapshot_stops_at_the_period_end(spark):
    ev = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 1, 9), 4.0), (1, dt.datetime(2020, 1, 5, 9), 8.0)], "user_id int, ts timestamp, value double"
    )
    got = [(r["snapshot_date"], float(r["balance"])) for r in periodic_snapshot(ev, "user_id", "ts", "value", dt.date(2020, 1, 3)).collect()]
    assert sorted(got) == [(dt.date(2020, 1, d), 4.0) for d in (1, 2, 3)]
