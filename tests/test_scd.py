"""SCD loaders: the hand-made edge cases, and merge == rebuild."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import checks as C
from starloom.operators.scd import (
    SnapshotRejected,
    merge_snapshot,
    rebuild_history,
    replay_snapshots,
    type1_merge,
    type1_rebuild,
    type3_merge,
    type3_rebuild,
)
from starloom.schemas import END_OF_TIME, Scd2Spec

SPEC = Scd2Spec(natural_key="id", tracked=("segment", "city"), attributes=("segment", "city", "name"), key="k")
SCHEMA = "as_of date, id int, segment string, city string, name string"
D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2020, 6, 1), dt.date(2021, 1, 1)


def snaps(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def replay(spark, rows, spec=SPEC):
    s = snaps(spark, rows)
    dates = sorted({r[0] for r in rows})
    return replay_snapshots(s, spec, dates=dates)


def versions(dim, nk="id"):
    return [r.asDict() for r in dim.orderBy(nk, "version").collect()]


def test_new_member(spark):
    v = versions(replay(spark, [(D1, 1, "A", "x", "n")]).dimension)
    assert len(v) == 1
    assert (v[0]["valid_from"], v[0]["valid_to"], v[0]["is_current"], v[0]["version"]) == (D1, END_OF_TIME, True, 1)


def test_unchanged_is_a_noop(spark):
    res = replay(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "A", "x", "n")])
    assert len(versions(res.dimension)) == 1
    assert res.counts == {"inserted": 0, "versioned": 0, "unchanged": 1}


def test_tracked_change_tiles(spark):
    v = versions(replay(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "B", "x", "n")]).dimension)
    assert [(r["valid_from"], r["valid_to"], r["is_current"]) for r in v] == [
        (D1, D2, False),
        (D2, END_OF_TIME, True),
    ]


def test_two_attributes_at_once_make_one_version(spark):
    v = versions(replay(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "B", "y", "n")]).dimension)
    assert len(v) == 2


def test_there_and_back(spark):
    v = versions(replay(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "B", "x", "n"), (D3, 1, "A", "x", "n")]).dimension)
    assert [r["segment"] for r in v] == ["A", "B", "A"]


def test_untracked_only_is_ignored_and_rides_along(spark):
    v = versions(replay(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "A", "x", "m")]).dimension)
    assert len(v) == 1 and v[0]["name"] == "n"
    v = versions(replay(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "B", "x", "m")]).dimension)
    assert [r["name"] for r in v] == ["n", "m"]


def test_absent_member_then_back(spark):
    rows = [(D1, 1, "A", "x", "n"), (D2, 2, "A", "x", "n"), (D3, 1, "A", "x", "n")]
    assert len(versions(replay(spark, rows).dimension.where("id = 1"))) == 1
    rows = [(D1, 1, "A", "x", "n"), (D2, 2, "A", "x", "n"), (D3, 1, "B", "x", "n")]
    v = versions(replay(spark, rows).dimension.where("id = 1"))
    assert [(r["valid_from"], r["valid_to"]) for r in v] == [(D1, D3), (D3, END_OF_TIME)]


def test_null_tracked_is_null_safe(spark):
    v = versions(replay(spark, [(D1, 1, None, "x", "n"), (D2, 1, None, "x", "n"), (D3, 1, "A", "x", "n")]).dimension)
    assert len(v) == 2


def test_duplicate_member_is_rejected(spark):
    with pytest.raises(SnapshotRejected, match="duplicate"):
        merge_snapshot(None, snaps(spark, [(D1, 1, "A", "x", "n"), (D1, 1, "B", "x", "n")]), D1, SPEC)


def test_null_member_key_is_rejected(spark):
    with pytest.raises(SnapshotRejected, match="NULL"):
        merge_snapshot(None, snaps(spark, [(D1, 1, "A", "x", "n"), (D1, None, "B", "x", "n")]), D1, SPEC)
    with pytest.raises(SnapshotRejected, match="NULL"):
        rebuild_history(snaps(spark, [(D1, 1, "A", "x", "n"), (D2, None, "B", "x", "n")]), SPEC)


def test_duplicate_member_is_rejected_by_rebuild(spark):
    with pytest.raises(SnapshotRejected, match="duplicate"):
        rebuild_history(snaps(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "A", "x", "n"), (D2, 1, "A", "x", "n")]), SPEC)


def test_out_of_order_and_same_day_changes_are_rejected(spark):
    dim = replay(spark, [(D2, 1, "A", "x", "n")]).dimension
    with pytest.raises(SnapshotRejected):
        merge_snapshot(dim, snaps(spark, [(D1, 1, "B", "x", "n")]), D1, SPEC)
    with pytest.raises(SnapshotRejected):
        merge_snapshot(dim, snaps(spark, [(D2, 1, "B", "x", "n")]), D2, SPEC)


def test_member_without_current_version_is_refused(spark):
    broken = spark.createDataFrame(
        [(1, 1, "A", "x", "n", D1, D2, False, 1)],
        "k long, id int, segment string, city string, name string, valid_from date, valid_to date, "
        "is_current boolean, version int",
    )
    with pytest.raises(SnapshotRejected, match="one current version"):
        merge_snapshot(broken, snaps(spark, [(D3, 1, "B", "x", "n")]), D3, SPEC)


def test_empty_snapshot(spark):
    dim = replay(spark, [(D1, 1, "A", "x", "n")]).dimension
    res = merge_snapshot(dim, snaps(spark, []), D2, SPEC)
    assert res.counts == {"inserted": 0, "versioned": 0, "unchanged": 0}
    assert versions(res.dimension) == versions(dim)


def test_rerun_of_last_snapshot_is_idempotent(spark):
    rows = [(D1, 1, "A", "x", "n"), (D1, 2, "A", "y", "n"), (D2, 1, "B", "x", "n"), (D2, 2, "A", "y", "n")]
    res = replay(spark, rows)
    again = merge_snapshot(res.dimension, snaps(spark, [r for r in rows if r[0] == D2]), D2, SPEC)
    assert again.counts == {"inserted": 0, "versioned": 0, "unchanged": 2}
    assert sorted(map(str, versions(again.dimension))) == sorted(map(str, versions(res.dimension)))


def _random_history(seed, members=40, dates=6):
    rnd = random.Random(seed)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=30 * i) for i in range(dates)]
    rows = []
    for m in range(members):
        seg, city = rnd.choice("AB"), rnd.choice(["x", "y", None])
        for d in days:
            if rnd.random() < 0.2:
                continue  # absent from this snapshot
            if rnd.random() < 0.4:
                seg = rnd.choice(["A", "B", None])
            if rnd.random() < 0.3:
                city = rnd.choice(["x", "y"])
            rows.append((d, m, seg, city, f"n{rnd.randint(0, 3)}"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_replay_equals_rebuild(spark, seed):
    rows = _random_history(seed)
    merged = replay(spark, rows).dimension
    rebuilt = rebuild_history(snaps(spark, rows), SPEC)
    assert merged.exceptAll(rebuilt).count() == 0
    assert rebuilt.exceptAll(merged).count() == 0
    bad = C.failures(
        C.metrics([C.one_current(rebuilt, SPEC), C.tiling(rebuilt, SPEC)]),
        {m: 0 for m in ["members_not_one_current", "gap", "last_not_open", "wrong_current", "empty_window", "version_hole"]},
    )
    assert not bad


@pytest.mark.parametrize("scope", ["all", "current"])
def test_hybrid_merge_equals_rebuild(spark, scope):
    spec = Scd2Spec(
        natural_key="id",
        tracked=("segment", "city"),
        attributes=("segment", "city", "name"),
        key="k",
        type1=("name",),
        type1_scope=scope,
    )
    rows = _random_history(7)
    merged = replay(spark, rows, spec).dimension
    rebuilt = rebuild_history(snaps(spark, rows), spec)
    assert merged.exceptAll(rebuilt).count() == 0
    assert rebuilt.exceptAll(merged).count() == 0


def test_type1_and_type3_merge_equal_rebuild(spark):
    rows = _random_history(3)
    s = snaps(spark, rows)
    dates = sorted({r[0] for r in rows})
    t1 = None
    t3 = None
    for d in dates:
        one = s.where(F.col("as_of") == F.lit(d))
        t1 = type1_merge(t1, one, "id", ("segment", "city", "name"), "k")
        t3 = type3_merge(t3, one, d, "id", "segment", "k")
    r1 = type1_rebuild(s, "id", ("segment", "city", "name"), "k")
    r3 = type3_rebuild(s, "id", "segment", "k")
    assert t1.exceptAll(r1).count() == 0 and r1.exceptAll(t1).count() == 0
    assert t3.exceptAll(r3).count() == 0 and r3.exceptAll(t3).count() == 0


def test_hot_duplicate_member_is_rejected_and_listed(spark):
    from starloom.operators.scd import validate_members

    rows = [(D1, 1, "A", "x", "n")] * 5000 + [(D1, i, "A", "x", "n") for i in range(2, 50)]
    s = snaps(spark, rows)
    with pytest.raises(SnapshotRejected, match=r"\(1, datetime.date\(2020, 1, 1\)\)"):
        validate_members(s, "id", "as_of")
    assert validate_members(snaps(spark, rows[4999:]), "id", "as_of") == 49


def test_stored_merge_reads_no_closed_version(spark, tmp_path, monkeypatch):
    import dataclasses

    from starloom.plans import warehouse as W

    rows = [(D1, 1, "A", "x", "n"), (D1, 2, "A", "y", "n"), (D2, 1, "B", "x", "m"), (D2, 2, "A", "y", "m"), (D3, 1, "A", "x", "o"), (D3, 3, "C", "z", "o")]
    for spec in (SPEC, dataclasses.replace(SPEC, type1=("name",)), dataclasses.replace(SPEC, type1=("name",), type1_scope="current")):
        path, reads = str(tmp_path / f"{len(spec.type1)}{spec.type1_scope}"), []
        real = W._read_closed
        with monkeypatch.context() as m:
            m.setattr(W, "_read_closed", lambda *a, real=real, reads=reads: reads.append(1) or real(*a))
            for d in (D1, D2, D3):
                snap = snaps(spark, [r for r in rows if r[0] == d])
                plans = []
                with monkeypatch.context() as inner:
                    write = W.cut_lineage
                    inner.setattr(
                        "starloom.operators.scd.cut_lineage",
                        lambda df, name, plans=plans, write=write: plans.extend(df.inputFiles()) or write(df, name),
                    )
                    W.merge_into(spark, path, snap, d, spec)
                assert not any("/closed/" in f for f in plans)
        # closed parts are read only to restate Type-1 columns in all versions
        assert bool(reads) == (spec.type1 != () and spec.type1_scope == "all")
        stored = sorted(map(str, versions(W.read_dimension(spark, path))))
        assert stored == sorted(map(str, versions(rebuild_history(snaps(spark, rows), spec))))
        assert W.dimension_parts(spark, path).next_key == 6 and W.read_current(spark, path).count() == 3
        again = W.merge_into(spark, path, snaps(spark, [r for r in rows if r[0] == D3]), D3, spec)
        assert not again.changed and W.committed_versions(spark, path) == [1, 2, 3]


def test_stored_merge_takes_a_whole_dimension_apart(spark, tmp_path):
    from starloom.plans import warehouse as W

    rows = [(D1, 1, "A", "x", "n"), (D1, 2, "A", "y", "n"), (D2, 1, "B", "x", "m"), (D2, 2, "A", "y", "m"), (D3, 1, "A", "x", "o"), (D3, 2, "A", "z", "o")]
    path = str(tmp_path / "d")
    W.write_dimension(rebuild_history(snaps(spark, rows[:4]), SPEC), path)
    W.merge_into(spark, path, snaps(spark, rows[4:]), D3, SPEC)
    stored = sorted(map(str, versions(W.read_dimension(spark, path))))
    assert stored == sorted(map(str, versions(rebuild_history(snaps(spark, rows), SPEC))))
    assert W.read_current(spark, path).count() == 2


def test_stored_merge_is_checked_before_it_is_committed(spark, tmp_path):
    from starloom.plans import warehouse as W

    dim = rebuild_history(snaps(spark, [(D1, 1, "A", "x", "n"), (D2, 1, "B", "x", "n")]), SPEC)
    now, closed = dim.where("is_current"), dim.where("not is_current")
    W.assert_merge_publishable(now, closed, SPEC)
    for a, b in (
        (now.unionByName(now), closed),
        (now.withColumn("is_current", F.lit(False)), closed),
        (now, closed.withColumn("valid_to", F.lit(D3))),
        (now, closed.withColumn("version", F.lit(7))),
        (now.where("false"), closed),
    ):
        with pytest.raises(W.UnsafeVersion):
            W.assert_merge_publishable(a, b, SPEC)


def test_stored_merge_keeps_a_correction_that_opens_no_version(spark, tmp_path):
    import dataclasses

    from starloom.plans import warehouse as W

    spec, path = dataclasses.replace(SPEC, type1=("name",)), str(tmp_path / "d")
    rows = [(D1, 1, "A", "x", "n"), (D2, 1, "B", "x", "n"), (D3, 1, "B", "x", "corrected")]
    for row in rows:
        W.merge_into(spark, path, snaps(spark, [row]), row[0], spec)
    assert {r["name"] for r in versions(W.read_dimension(spark, path))} == {"corrected"}
    W.merge_into(spark, path, snaps(spark, rows[2:]), D3, spec)
    assert W.committed_versions(spark, path) == [1, 2, 3]
