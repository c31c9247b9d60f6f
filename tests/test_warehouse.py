"""The persisted warehouse: build, idempotent re-run, invariants, reloads.

End-to-end invariants (grain, referential integrity,
one current version, tiling, versioning, idempotency, reconciliation,
coverage) on the driver's sf0.001 tables.
"""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from starloom.operators import checks as C
from starloom.plans import analytics as A
from starloom.plans.warehouse import (
    build,
    committed_versions,
    idempotency_check,
    read_dimension,
    read_fact,
    OutsideWindow,
    reload_window,
    write_fact,
)
from starloom.schemas import CUSTOMER_SPEC

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("wh"))
    stats = build(spark, SF_SMALL, out)
    return out, stats


def test_build_stats(warehouse):
    _, stats = warehouse
    assert stats.customers == 150 and stats.products == 200 and stats.stores == 10
    loads = stats.scd_loads
    assert loads[0] == {"inserted": 150, "versioned": 0, "unchanged": 0}
    assert loads[1]["inserted"] == 0 and loads[1]["versioned"] > 0
    assert sum(loads[1].values()) == 150
    assert stats.customer_versions == 150 + loads[1]["versioned"] + loads[2]["versioned"]


def test_fact_grain_and_keys(spark, warehouse):
    out, stats = warehouse
    fact = read_fact(spark, f"{out}/fact_sales")
    stg = spark.read.parquet(f"{out}/stg_sales")
    assert fact.count() == stg.count() == stats.fact_rows
    dims = {
        "customer_key": read_dimension(spark, f"{out}/dim_customer"),
        "product_key": read_dimension(spark, f"{out}/dim_product"),
        "store_key": read_dimension(spark, f"{out}/dim_store"),
        "date_key": spark.read.parquet(f"{out}/dim_date"),
    }
    assert all(v == 0 for v in {r["metric"]: r["value"] for r in C.orphans(fact, dims).collect()}.values())
    assert fact.select("sale_key").distinct().count() == fact.count()


def test_dimension_invariants(spark, warehouse):
    out, _ = warehouse
    dim = read_dimension(spark, f"{out}/dim_customer")
    got = {r["metric"]: r["value"] for r in C.metrics(
        [C.one_current(dim, CUSTOMER_SPEC), C.tiling(dim, CUSTOMER_SPEC), C.multi_version(dim, CUSTOMER_SPEC)]
    ).collect()}
    assert got.pop("members_with_history") > 0
    assert all(v == 0 for v in got.values()), got


def test_rerun_is_a_noop(spark, warehouse):
    out, _ = warehouse
    before = committed_versions(spark, f"{out}/dim_customer")
    res = idempotency_check(spark, SF_SMALL, out)
    assert res["rows_before"] == res["rows_after"]
    assert res["load_stats"] == {"inserted": 0, "versioned": 0, "unchanged": 150}
    assert committed_versions(spark, f"{out}/dim_customer") == before


def test_build_can_be_rerun_into_the_same_folder(spark, warehouse):
    out, stats = warehouse
    again = build(spark, SF_SMALL, out)
    assert again.customer_versions == stats.customer_versions
    assert again.fact_rows == stats.fact_rows
    assert again.scd_loads == []  # every snapshot was already applied


def test_incremental_day_load_is_idempotent(spark, warehouse):
    from starloom.plans.warehouse import load_increment

    out, stats = warehouse
    stg = spark.read.parquet(f"{out}/stg_sales")
    day = stg.groupBy("order_date").count().orderBy(F.desc("count")).first()["order_date"]
    before = read_fact(spark, f"{out}/fact_sales")
    n_before = before.count()
    batch = stg.where(F.col("order_date") == F.lit(day))
    n_day = load_increment(spark, out, batch, day, day)
    n_again = load_increment(spark, out, batch, day, day)  # a re-run replaces, never duplicates
    after = read_fact(spark, f"{out}/fact_sales")
    assert n_day == n_again == batch.count()
    assert after.count() == n_before
    assert after.select("sale_key").distinct().count() == n_before


def test_lines_without_a_member_are_kept_or_refused(spark, warehouse):
    from starloom.plans.warehouse import UnsafeLoad, load_increment

    out, stats = warehouse
    stg = spark.read.parquet(f"{out}/stg_sales")
    day = stg.groupBy("order_date").count().orderBy(F.desc("count")).first()["order_date"]
    whole = stg.where(F.col("order_date") == F.lit(day))
    first = whole.agg(F.min("order_id")).first()[0]
    stray = F.when(F.col("order_id") == first, F.lit(-5)).otherwise(F.col("customer_id")).cast("long")
    batch = whole.withColumn("customer_id", stray)
    n = batch.where("customer_id = -5").count()
    with pytest.raises(UnsafeLoad, match="fact_lines"):
        load_increment(spark, out, batch, day, day, mode="inner")
    assert read_fact(spark, f"{out}/fact_sales").count() == stats.fact_rows
    assert load_increment(spark, out, batch, day, day) == batch.count()
    unknown = read_fact(spark, f"{out}/fact_sales").where("customer_key = -1")
    assert unknown.count() == n > 0
    for name in ("product", "store", "customer"):
        assert read_dimension(spark, f"{out}/dim_{name}").where(f"{name}_key = -1").count() == 1
    load_increment(spark, out, whole, day, day)  # as it was, for the other tests


def test_a_broken_version_is_not_published(spark):
    from starloom.plans.warehouse import UnsafeVersion, assert_publishable

    bad = spark.createDataFrame(
        [(1, 7, dt.date(2020, 1, 1), dt.date(9999, 12, 31), True, 1), (2, 7, dt.date(2020, 6, 1), dt.date(9999, 12, 31), True, 2)],
        "customer_key long, customer_id int, valid_from date, valid_to date, is_current boolean, version int",
    )
    with pytest.raises(UnsafeVersion):
        assert_publishable(bad, CUSTOMER_SPEC)


def test_half_written_version_is_ignored(spark, warehouse):
    out, _ = warehouse
    for name, mark in (("product", "_SUCCESS"), ("customer", "part.json")):
        path = f"{out}/dim_{name}"
        live, rows = committed_versions(spark, path)[-1], read_dimension(spark, path).count()
        # a load that died before commit leaves files but no marker
        spark.range(3).write.parquet(f"{path}/v={live + 1}" + ("" if name == "product" else "/current"))
        if name == "product":
            os.remove(f"{path}/v={live + 1}/{mark}")
        assert committed_versions(spark, path)[-1] == live
        assert read_dimension(spark, path).count() == rows


def test_same_batch_again_has_the_same_keys_and_reads_no_history(spark, warehouse, monkeypatch):
    from starloom.plans import warehouse as W
    from starloom.plans.publish import latest

    out, _ = warehouse
    stg = spark.read.parquet(f"{out}/stg_sales")
    first, last = dt.date(1998, 7, 1), dt.date(1998, 8, 15)
    batch = stg.where(F.col("order_date").between(F.lit(first), F.lit(last)))

    def keyed():
        fact = read_fact(spark, f"{out}/fact_sales").where("date_key between 19980701 and 19980815")
        return sorted(map(tuple, fact.collect()))

    free = latest(spark, f"{out}/fact_sales").next_key
    W.load_increment(spark, out, batch, first, last)
    seen = keyed()
    assert min(r[0] for r in seen) == free
    reads = []
    real = W.read_table
    monkeypatch.setattr(W, "read_table", lambda s, p, t, live, months=None: reads.append(months) or real(s, p, t, live, months))
    W.load_increment(spark, out, batch.repartition(6), first, last)
    assert keyed() == seen
    # only the window's months were looked at, for the days outside the window
    assert all(m is not None and m <= {"199807", "199808"} for m in reads[:2])
    W.load_increment(spark, out, batch.where("quantity > 1"), first, last)
    assert min(r[0] for r in keyed()) > max(r[0] for r in seen)
    W.load_increment(spark, out, batch, first, last)  # as it was, for the other tests
    fact = read_fact(spark, f"{out}/fact_sales")
    assert fact.select("sale_key").distinct().count() == fact.count()


def test_repair_rewrites_the_touched_months_only(spark, warehouse, tmp_path):
    from starloom.plans import warehouse as W
    from starloom.plans.publish import latest

    from .test_publish import files

    out, _ = warehouse
    stg = spark.read.parquet(f"{out}/stg_sales").where("order_date between '1996-01-01' and '1996-12-31'")
    stray = stg.where("month(order_date) = 5").agg(F.min("customer_id")).first()[0]
    nowhere = 10**9
    lines = stg.withColumn(
        "customer_id",
        F.when((F.col("customer_id") == stray) & (F.month("order_date") == 5), F.lit(stray + 10**8))
        .when((F.col("line_number") == 1) & (F.month("order_date") == 6), F.lit(nowhere))
        .otherwise(F.col("customer_id")),
    )
    mine = str(tmp_path / "wh")
    for name in ("product", "store", "customer"):
        dim = read_dimension(spark, f"{out}/dim_{name}")
        W.write_dimension(dim, f"{mine}/dim_{name}")
    spark.read.parquet(f"{out}/dim_date").write.parquet(f"{mine}/dim_date")
    window = dt.date(1996, 1, 1), dt.date(1996, 12, 31)
    n = W.load_increment(spark, mine, lines, *window)
    path = f"{mine}/fact_sales"
    parked = W.read_parked(spark, path)
    n_may, n_june = (parked.where(f"month_key = 19960{m}").count() for m in (5, 6))
    assert parked.count() == n_may + n_june == read_fact(spark, path).where("customer_key = -1").count()
    assert n_may > 0 and n_june > 0
    assert W.repair_parked(spark, mine) == 0
    # the member arrives, with a version that starts after the lines' dates
    before, old, stamps = read_fact(spark, path).where("customer_key <> -1"), latest(spark, path), files(path)
    settled = sorted(map(tuple, before.collect()))
    known = read_dimension(spark, f"{mine}/dim_customer")
    snapshot = known.where(F.col("customer_id") == stray).orderBy("version").limit(1)
    snapshot = snapshot.select(F.lit(stray + 10**8).alias("customer_id"), *CUSTOMER_SPEC.attributes)
    W.merge_into(spark, f"{mine}/dim_customer", snapshot, dt.date(2001, 1, 1), CUSTOMER_SPEC)
    key = read_dimension(spark, f"{mine}/dim_customer").where(F.col("customer_id") == stray + 10**8).first()["customer_key"]
    assert W.repair_parked(spark, mine) == n_may
    fact, live = read_fact(spark, path), latest(spark, path)
    assert fact.count() == n and fact.where("customer_key = -1").count() == n_june
    assert fact.where(F.col("customer_key") == key).count() == n_may
    assert sorted(map(tuple, fact.where(~F.col("customer_key").isin(-1, key)).collect())) == settled
    changed = {m for m, load in live.months["sales"].items() if old.months["sales"][m] != load}
    assert changed == {"199605"}
    assert {f: t for f, t in files(path).items() if f in stamps} == stamps
    assert W.read_parked(spark, path).count() == n_june and W.repair_parked(spark, mine) == 0


def test_window_reload_replaces_only_that_month(spark, tmp_path):
    fact = spark.createDataFrame(
        [(1, 20200105, 1), (2, 20200210, 2), (3, 20200215, 3)], "sale_key long, date_key int, quantity int"
    )
    path = str(tmp_path / "f")
    write_fact(fact.where("sale_key != 3"), path)
    batch = fact.where("date_key > 20200200")
    reload_window(batch, path, dt.date(2020, 2, 1), dt.date(2020, 2, 29))
    reload_window(batch, path, dt.date(2020, 2, 1), dt.date(2020, 2, 29))
    got = sorted(r["sale_key"] for r in read_fact(spark, path).collect())
    assert got == [1, 2, 3]


def test_reload_refuses_rows_outside_and_an_empty_one_empties_the_window(spark, tmp_path):
    fact = spark.createDataFrame(
        [(1, 20200105, 1), (2, 20200210, 2), (3, 20200215, 3), (4, None, 4)], "sale_key long, date_key int, quantity int"
    )
    path = str(tmp_path / "f")
    write_fact(fact.where("date_key is not null"), path, whole=True)
    with pytest.raises(OutsideWindow, match="2 rows"):
        reload_window(fact, path, dt.date(2020, 2, 1), dt.date(2020, 2, 29))
    assert read_fact(spark, path).count() == 3
    reload_window(fact.limit(0), path, dt.date(2020, 2, 11), dt.date(2020, 2, 29))
    assert sorted(r["sale_key"] for r in read_fact(spark, path).collect()) == [1, 2]
    reload_window(fact.limit(0), path, dt.date(2020, 2, 1), dt.date(2020, 2, 29))
    assert [r["sale_key"] for r in read_fact(spark, path).collect()] == [1]
    write_fact(fact.where("sale_key = 3"), path, whole=True)
    assert [r["sale_key"] for r in read_fact(spark, path).collect()] == [3]


def test_reloading_one_day_keeps_the_rest_of_its_month(spark, tmp_path):
    fact = spark.createDataFrame(
        [(1, 20200203, 1), (2, 20200210, 2), (3, 20200210, 3), (4, 20200301, 4)],
        "sale_key long, date_key int, quantity int",
    )
    path = str(tmp_path / "f")
    write_fact(fact, path)
    # the re-extract of 2020-02-10 has one corrected line and lost another
    fixed = spark.createDataFrame([(2, 20200210, 20)], "sale_key long, date_key int, quantity int")
    reload_window(fixed, path, dt.date(2020, 2, 10), dt.date(2020, 2, 10))
    got = sorted((r["sale_key"], r["quantity"]) for r in read_fact(spark, path).collect())
    assert got == [(1, 1), (2, 20), (4, 4)]
    reload_window(fixed, path, dt.date(2020, 2, 10), dt.date(2020, 2, 10))
    assert sorted((r["sale_key"], r["quantity"]) for r in read_fact(spark, path).collect()) == got


def test_month_filter_prunes_partitions(spark, warehouse, capsys):
    out, _ = warehouse
    q = read_fact(spark, f"{out}/fact_sales").where(F.col("month_key").between(199801, 199806))
    q.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(month_key" in plan


def test_analytics_reconcile_on_the_built_star(spark):
    from starloom.plans.star import build_star

    star = build_star(spark, SF_SMALL)
    trend = A.monthly_trend(star)
    assert trend.agg(F.sum("order_lines")).first()[0] == star.fact.count()
    q4 = A.segment_pit_vs_current(star).collect()
    assert any(r["delta"] != 0 for r in q4)
    pair = A.segment_attribution(star)
    total = star.fact.agg(F.sum("net_amount")).first()[0]
    assert pair.agg(F.sum("net")).first()[0] == total
    assert pair.where("cur_segment is not null").agg(F.sum("net")).first()[0] == total


def test_results_do_not_depend_on_partitioning(spark):
    from starloom.plans.registry import REGISTRY

    fn = REGISTRY["fact_resolve"][0]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = fn(spark, SF_SMALL)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    b = fn(spark, SF_SMALL)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_member_that_arrives_leaves_the_stored_sums_alone(spark, warehouse, tmp_path):
    from starloom.plans import warehouse as W
    from starloom.plans.publish import latest

    out, _ = warehouse
    stg = spark.read.parquet(f"{out}/stg_sales").where("order_date between '1996-05-01' and '1996-05-31'")
    stray = stg.agg(F.min("customer_id")).first()[0]
    late = F.when(F.col("customer_id") == stray, F.lit(stray + 10**8)).otherwise(F.col("customer_id"))
    mine = str(tmp_path / "wh")
    for name in ("product", "store", "customer"):
        W.write_dimension(read_dimension(spark, f"{out}/dim_{name}"), f"{mine}/dim_{name}")
    spark.read.parquet(f"{out}/dim_date").write.parquet(f"{mine}/dim_date")
    W.load_increment(spark, mine, stg.withColumn("customer_id", late), dt.date(1996, 5, 1), dt.date(1996, 5, 31))
    path = f"{mine}/fact_sales"
    old, sums = latest(spark, path), sorted(map(tuple, W.read_rollup(spark, path).collect()))
    known = read_dimension(spark, f"{mine}/dim_customer").where(F.col("customer_id") == stray).orderBy("version").limit(1)
    snapshot = known.select(F.lit(stray + 10**8).alias("customer_id"), *CUSTOMER_SPEC.attributes)
    W.merge_into(spark, f"{mine}/dim_customer", snapshot, dt.date(2001, 1, 1), CUSTOMER_SPEC)
    assert W.repair_parked(spark, mine) > 0
    live = latest(spark, path)
    assert live.months["sales"] != old.months["sales"] and live.months[W.ROLLUP] == old.months[W.ROLLUP]
    assert sorted(map(tuple, W.read_rollup(spark, path).collect())) == sums
    # a product's arrival would change them: the whole fact gives the same sums
    fresh = W._with_rollup(spark, path, live, live.months["sales"]["199605"], W._load_dimensions(spark, mine, "unknown"), lambda m: True)
    again = W.read_table(spark, path, W.ROLLUP, fresh).drop(W.FACT_PARTITION)
    assert sorted(map(tuple, again.collect())) == sums


def test_rows_dealt_out_by_month_once_are_written_as_they_lie(spark, tmp_path, monkeypatch):
    from starloom.plans import warehouse as W

    asked, hint = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, *a: asked.append(a) or hint(df, *a))
    rows = [(k, 20200100 + (k % 3) * 100 + 1) for k in range(60)]
    fact = W.fact_by_month(spark.createDataFrame(rows, "sale_key long, date_key int"))
    path = str(tmp_path / "fact")
    for least in (0, 20200200):  # the second load keeps no month of the first
        W.write_fact(fact.where(F.col("date_key") > least), path, whole=True, clustered=True)
        found = sorted(map(tuple, W.read_fact(spark, path).select("sale_key", "date_key", "month_key").collect()))
        assert found == [(k, d, d // 100) for k, d in rows if d > least]
    assert len(asked) == 1
