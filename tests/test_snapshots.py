"""Stored snapshot facts, the rollup kept by loads, and checks in one scan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import checks as C
from starloom.operators.facts import accumulated, accumulating_snapshot, periodic_snapshot, preaggregate
from starloom.plans import snapshots as S
from starloom.plans import warehouse as W
from starloom.plans.publish import latest
from starloom.plans.registry import REGISTRY

from .conftest import SF_SMALL

DAY = dt.timedelta(days=1)


def shipments(spark, rows):
    return spark.createDataFrame(rows, "order_id int, order_date date, ship_date date")


def test_a_batch_that_comes_again_counts_once(spark, scratch):
    rnd, start = random.Random(5), dt.date(2020, 1, 1)
    rows = []
    for o in [*range(60), None]:
        day = start + rnd.randint(0, 300) * DAY
        rows += [(o, day, day + rnd.randint(0, 90) * DAY) for _ in range(rnd.randint(1, 5))]
    rnd.shuffle(rows)
    parts = {"a": rows[:40], "b": rows[40:90], "c": rows[90:]}
    for name in ("a", "b", "c", "b", "a"):
        S.fold_batch(shipments(spark, parts[name]), scratch, name)
    want = accumulating_snapshot(shipments(spark, rows))
    got = S.accumulating_fact(spark, scratch)
    assert got.count() == want.count() and got.where("order_id is null").count() == 1
    assert got.select(*want.columns).exceptAll(want).count() == 0
    # a corrected delivery replaces the first one, an empty one takes it back
    S.fold_batch(shipments(spark, parts["b"][:5]), scratch, "b")
    S.fold_batch(shipments(spark, rows).limit(0), scratch, "c")
    want = accumulating_snapshot(shipments(spark, parts["a"] + parts["b"][:5]))
    assert S.accumulating_fact(spark, scratch).exceptAll(want).count() == 0


def test_days_carried_forward_equal_one_full_build(spark, scratch, monkeypatch):
    rnd, start = random.Random(7), dt.datetime(2024, 1, 1)
    rows = [
        (rnd.choice([1, 1, 1, 2, 3, 4, None]), start + dt.timedelta(hours=rnd.randint(0, 120)), rnd.choice([None, 1.25, -3.5, 10.0]))
        for _ in range(200)
    ]
    events = spark.createDataFrame(rows, "user_id int, ts timestamp, value double")
    first = start.date()
    reads = []
    real = S.read_table
    monkeypatch.setattr(S, "read_table", lambda s, p, t, live, months=None, part=None: reads.append(months) or real(s, p, t, live, months, part))
    for n in range(6):
        S.close_day(events, scratch, "user_id", "ts", "value", first + n * DAY)
    S.close_day(events, scratch, "user_id", "ts", "value", first + 3 * DAY)  # closed again
    assert reads[:5] == [{(first + n * DAY).isoformat()} for n in range(5)]
    want = periodic_snapshot(events, "user_id", "ts", "value", first + 5 * DAY)
    got = S.closed_days(spark, scratch).select(*want.columns)
    assert got.count() == want.count() > 20
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert S.closed_days(spark, scratch, [first]).select("snapshot_date").distinct().count() == 1
    with pytest.raises(ValueError, match="in order"):
        S.close_day(events, scratch, "user_id", "ts", "value", first + 9 * DAY)


@pytest.mark.parametrize("name", ["check_totals", "check_trend", "region_two_ways", "preaggregate_reconciles"])
def test_check_scans_the_lines_once(spark, name, capsys):
    REGISTRY[name][0](spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert plan.count("lineitem.parquet") == 1, plan


def test_a_check_sees_lines_that_a_join_loses_or_doubles(spark):
    from starloom.plans import analytics as A

    fact = spark.createDataFrame([(1, 20200101), (2, 20200102), (3, 20200109)], "quantity int, date_key int")
    fact = fact.withColumn("net_amount", F.lit(1).cast("decimal(12,2)"))
    days = A.day_sums(C.with_total(fact, ["date_key"], ["quantity", "net_amount"]), C.TOTAL)
    for dates in ([20200101, 20200102], [20200101, 20200101, 20200102, 20200109]):
        cal = spark.createDataFrame([(d, "2020-01") for d in dates], "date_key int, year_month string")
        got = A.month_sums(days, cal, "left", (C.TOTAL,))
        lost = {bool(r[C.TOTAL]): r["order_lines"] for r in got.where(f"{C.TOTAL} or year_month is not null").collect()}
        assert lost[True] == 3 and lost[False] != 3


def test_rollup_follows_the_loads_and_touches_their_months_only(spark, tmp_path):
    out = str(tmp_path / "wh")
    W.build(spark, SF_SMALL, out)
    path, stg = f"{out}/fact_sales", spark.read.parquet(f"{out}/stg_sales")

    def rebuilt():
        fact = W.read_fact(spark, path)
        return preaggregate(fact, spark.read.parquet(f"{out}/dim_date"), W.read_dimension(spark, f"{out}/dim_product"))

    def same():
        a, b = W.read_rollup(spark, path), rebuilt()
        a = a.select(*b.columns)
        return a.count() == b.count() and a.exceptAll(b).count() == 0

    assert same()
    before = latest(spark, path)
    first, last = dt.date(1998, 7, 10), dt.date(1998, 8, 20)
    batch = stg.where(F.col("order_date").between(F.lit(first), F.lit(last)) & (F.col("quantity") < 20))
    W.load_increment(spark, out, batch, first, last)
    after = latest(spark, path)
    moved = {m for m, load in after.months[W.ROLLUP].items() if before.months[W.ROLLUP][m] != load}
    assert same() and moved == {"199807", "199808"}
    # a window that loses all its lines loses their sums
    W.load_increment(spark, out, batch.limit(0), dt.date(1998, 7, 1), dt.date(1998, 7, 31))
    assert same() and W.read_rollup(spark, path).where("year_month = '1998-07'").count() == 0


def test_accumulated_of_one_batch_is_that_batch(spark):
    one = accumulating_snapshot(shipments(spark, [(1, dt.date(2020, 1, 1), dt.date(2020, 1, 3)), (1, dt.date(2020, 1, 1), None)]))
    assert accumulated(one).exceptAll(one).count() == 0
