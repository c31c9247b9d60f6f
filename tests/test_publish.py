"""Published month versions: one switch a load, nothing lost by a crash or a second load."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from starloom.plans import publish as P
from starloom.plans import warehouse as W

SCHEMA = "sale_key long, date_key int, quantity int"
JAN, FEB, MAR = 20200105, 20200210, 20200301


def rows(spark, *keys_and_dates):
    return spark.createDataFrame([(k, d, k * 10) for k, d in keys_and_dates], SCHEMA)


def keys(spark, path):
    return sorted(r["sale_key"] for r in W.read_fact(spark, path).collect())


def files(path, table="sales"):
    found = {}
    for folder, _, names in os.walk(f"{path}/{table}"):
        for n in names:
            if n.endswith(".parquet"):
                found[os.path.join(folder, n)] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return found


def test_a_load_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "f")
    W.write_fact(rows(spark, (1, JAN), (2, FEB), (3, MAR)), path, whole=True)
    window = dt.date(2020, 1, 1), dt.date(2020, 3, 31)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(W, "publish", dies)
        with pytest.raises(OSError):
            W.reload_window(rows(spark, (7, FEB)), path, *window)
        with pytest.raises(OSError):
            W.write_fact(rows(spark, (8, JAN)), path, whole=True)
    assert keys(spark, path) == [1, 2, 3]
    W.reload_window(rows(spark, (7, FEB)), path, *window)
    assert keys(spark, path) == [7]
    # the dead loads' folders and the replaced one go; what is live stays
    assert len(P.forget_old_loads(spark, path, keep=1)) == 3
    assert keys(spark, path) == [7] and P.forget_old_loads(spark, path, keep=1) == []


def test_reload_over_three_months_is_one_switch(spark, tmp_path):
    path = str(tmp_path / "f")
    W.write_fact(rows(spark, (1, JAN), (2, FEB), (3, MAR), (4, 20200401), (5, 20200131)), path, whole=True)
    before = P.latest(spark, path)
    W.reload_window(rows(spark, (6, FEB), (7, MAR)), path, dt.date(2020, 1, 1), dt.date(2020, 3, 15))
    after = P.latest(spark, path)
    assert after.number == before.number + 1
    # January went, April was not touched
    assert set(after.months["sales"]) == {"202002", "202003", "202004"}
    assert after.months["sales"]["202004"] == before.months["sales"]["202004"]
    assert keys(spark, path) == [4, 6, 7]


def test_the_second_of_two_loads_is_refused(spark, tmp_path):
    path = str(tmp_path / "f")
    W.write_fact(rows(spark, (1, JAN)), path, whole=True)
    old = P.latest(spark, path)
    W.reload_window(rows(spark, (2, JAN)), path, dt.date(2020, 1, 1), dt.date(2020, 1, 31))
    with pytest.raises(P.ConcurrentLoad):
        P.publish(spark, path, old)
    assert keys(spark, path) == [2]
    assert [n for n in os.listdir(f"{path}/live") if not n.endswith((".json", ".crc"))] == []


def test_readers_keep_their_months_while_a_load_replaces_them(spark, tmp_path):
    path = str(tmp_path / "f")
    W.write_fact(rows(spark, (1, JAN), (2, FEB)), path, whole=True)
    reader = W.read_fact(spark, path)
    W.write_fact(rows(spark, (3, JAN)), path, whole=True)
    assert sorted(r["sale_key"] for r in reader.collect()) == [1, 2]
    assert keys(spark, path) == [3]


def test_an_empty_fact_keeps_its_columns_and_undated_rows_are_kept(spark, tmp_path):
    path = str(tmp_path / "f")
    with pytest.raises(FileNotFoundError):
        W.read_fact(spark, path)
    W.write_fact(rows(spark).limit(0), path, whole=True)
    assert W.read_fact(spark, path).columns == ["sale_key", "date_key", "quantity", "month_key"]
    W.write_fact(rows(spark, (1, JAN), (2, None)), path)
    assert keys(spark, path) == [1, 2]
    W.reload_window(rows(spark).limit(0), path, dt.date(2020, 1, 1), dt.date(2020, 1, 31))
    assert keys(spark, path) == [2]


def test_key_ledger():
    live = P.Publication(next_key=101, batches={"a": [1, {"202001": 60, "202002": 40}]})
    start, starts, after = live.key_range("a", {"202002": 40, "202001": 60})
    assert (start, starts, after.next_key) == (1, {"202001": 1, "202002": 61}, 101)
    start, starts, after = live.key_range("a", {"202001": 61, "202002": 40})
    assert (start, starts, after.next_key) == (101, {"202001": 101, "202002": 162}, 202)
    assert after.batches["a"] == [101, {"202001": 61, "202002": 40}]
    assert live.key_range("b", {})[0] == 101


@pytest.mark.parametrize("per_bucket", [5_000_000, 70])
def test_numbers_are_dense_and_do_not_depend_on_partitions(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(W, "FACT_ROWS_PER_KEY_PARTITION", per_bucket)
    lines = spark.range(1000).select(
        F.col("id").alias("order_id"),
        (F.lit(20200101) + (F.col("id") % 3) * 100).cast("int").alias("date_key"),
        F.lit(7).alias("sale_key_before"),
    )
    staged = {"202001": 334, "202002": 333, "202003": 333}
    seen = []
    for n in (1, 6):
        numbered = W.number_lines(lines.repartition(n), staged, ["order_id"])
        start, starts, _ = P.Publication(next_key=50).key_range("x", W._months_of(numbered))
        got = W.keyed_lines(numbered, starts).collect()
        assert sorted(r["sale_key"] for r in got) == list(range(50, 1050))
        assert all(starts[str(r["month_key"])] <= r["sale_key"] for r in got)
        seen.append({r["order_id"]: r["sale_key"] for r in got})
    assert seen[0] == seen[1]


def test_gate_refuses_planted_keys_without_shuffling_them(spark, capsys):
    dims = {"date_key": spark.createDataFrame([(JAN,)], "date_key int")}
    for bad in ([1, 1, 4, 4], [1, 2, 3, 3], [0, 2, 3, 4], [1, 2, 3, 5]):
        lines = spark.createDataFrame([(k, JAN) for k in bad], "sale_key long, date_key int")
        with pytest.raises(W.UnsafeLoad, match="sale_key"):
            W.assert_loadable(lines, dims, 4, "unknown", 1, 4)
    lines = spark.createDataFrame([(k, JAN if k > 1 else FEB) for k in (4, 2, 1, 3)], "sale_key long, date_key int")
    with pytest.raises(W.UnsafeLoad, match="orphan_date_key"):
        W.assert_loadable(lines, dims, 4, "unknown", 1, 4)
    with pytest.raises(W.UnsafeLoad, match="fact_lines"):
        W.assert_loadable(lines, dims, 5, "unknown", 1, 4)
    W.assert_loadable(lines.where("sale_key > 1"), dims, 3, "unknown", 2, 3)
    lines.agg(F.count(F.lit(1)), W._key_hash(F.col("sale_key"))).explain()
    plan = capsys.readouterr().out
    assert "SinglePartition" in plan and "hashpartitioning(sale_key" not in plan
