"""Versioned dimensions: SCD Type 2 merge (K2-K4, K6), set-based rebuild (K5),
Type 1 (D1), Type 3 (D2) and hybrid Type 1 + Type 2 (D3, D25).

Every load is set-based. A Type-2 merge is one full outer join of the current
versions with the snapshot on the natural key, after which a generator emits
0, 1 or 2 rows per pair (carried, expired + new, inserted). Closed versions never
change (but for Type-1 columns restated in all versions), so a merge neither
reads nor rewrites them: the versions that it closes are handed over as a part
of their own. Only the action counters reach the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.predicates import any_changed_cols
from starloom.operators.keys import Keyed, assign_dense_keys, dense_keys, next_key
from starloom.schemas import END_OF_TIME, Scd2Spec
from starloom.session import cut_lineage

_ACTION = "_action"
_MAX_LISTED = 20  # how many offending keys an error message lists
_ROWS_PER_KEY_PARTITION = 2_000_000  # new versions numbered per range partition


class SnapshotRejected(ValueError):
    """A snapshot that would corrupt the dimension (duplicates, out of order)."""


#: What a merge can do with a snapshot's member.
ACTIONS = ("inserted", "versioned", "unchanged")


@dataclass
class MergeResult:
    """A merged dimension; ``counts`` has the number of members per action."""

    dimension: DataFrame
    counts: dict[str, int]
    per_snapshot: list[tuple[dt.date, dict[str, int]]] = field(default_factory=list)
    rows: int | None = None  # exact row count of ``dimension`` when known
    next_key: int | None = None  # first free surrogate key after this load
    current: DataFrame | None = None  # the open versions after this load
    closed: DataFrame | None = None  # the versions that this load closed

    @property
    def changed(self) -> bool:
        return self.counts["inserted"] + self.counts["versioned"] > 0


def validate_members(snapshots: DataFrame, natural_key: str, as_of_col: str | None = None) -> int:
    """Reject a snapshot listing a member twice (per ``as_of`` when stacked)
    or a member without a key; return the snapshot's row count.

    A hash aggregate: copies of one member are counted map-side before the
    shuffle, so even a member repeated millions of times never gathers its
    rows in one task. Only up to ``_MAX_LISTED`` offending keys reach the
    driver (in a second job, on the error path only).
    """
    keys = [natural_key] + ([as_of_col] if as_of_col else [])
    grouped = snapshots.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    bad_row = (F.col("_n") > 1) | F.col(natural_key).isNull()
    summary = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(bad_row).alias("bad")
    ).first()
    if summary["bad"]:
        bad = grouped.where(bad_row).select(*keys).limit(_MAX_LISTED).collect()
        listed = ", ".join(str(tuple(r)) if len(r) > 1 else str(r[0]) for r in bad)
        raise SnapshotRejected(f"duplicate or NULL {natural_key} in snapshot: {listed}")
    return int(summary["rows"])


def empty_dimension(snapshot: DataFrame, spec: Scd2Spec) -> DataFrame:
    return snapshot.where(F.lit(False)).select(
        F.lit(None).cast("long").alias(spec.key),
        spec.natural_key,
        *spec.attributes,
        F.lit(None).cast("date").alias(spec.valid_from),
        F.lit(None).cast("date").alias(spec.valid_to),
        F.lit(None).cast("boolean").alias(spec.is_current),
        F.lit(None).cast("int").alias(spec.version),
    )


# ---------------------------------------------------------------------------
# K2 / K3 / K6: merge one snapshot
# ---------------------------------------------------------------------------
def merge_snapshot(
    dim: DataFrame | None,
    snapshot: DataFrame,
    as_of: dt.date,
    spec: Scd2Spec,
    validate: bool = True,
    start_key: int | None = None,
) -> MergeResult:
    """Apply one dated snapshot to a Type-2 (optionally hybrid) dimension.

    new member -> version 1; tracked change -> expire current + new version
    (all attributes from the snapshot); no tracked change -> nothing (Type-1
    columns, if any, are overwritten in place). Members missing from the
    snapshot stay as they are. Raises :class:`SnapshotRejected` on duplicate
    members or on a change dated on/before the current version's start.
    ``start_key`` may pass the first free key when the caller knows it (a
    replay carries ``MergeResult.next_key``); otherwise it is ``max(key)+1``.

    The whole dimension is given and returned; a dimension stored in two parts
    is merged by :func:`merge_current`, which does not see closed versions.
    """
    if dim is None:
        return merge_current(None, snapshot, as_of, spec, validate, 1)
    start = start_key if start_key is not None else next_key(dim, spec.key)
    is_open = F.coalesce(F.col(spec.is_current), F.lit(False))
    before = dim.where(~is_open)
    res = merge_current(dim.where(is_open), snapshot, as_of, spec, validate, start)
    if validate and res.counts["inserted"]:
        # only a member that seemed new can have closed versions and no open one
        opened = res.current.where((F.col(spec.version) == 1) & (F.col(spec.key) >= F.lit(start)))
        lost = before.join(opened.select(spec.natural_key), spec.natural_key, "left_semi")
        n = lost.agg(F.count_distinct(spec.natural_key)).first()[0]
        if n:
            raise SnapshotRejected(
                f"snapshot {as_of}: {n} members have closed versions only; "
                "the dimension must hold exactly one current version per member"
            )
    res.dimension = restate_closed(before, snapshot, spec).unionByName(res.dimension)
    res.rows = None
    return res


def restate_closed(closed: DataFrame, snapshot: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Closed versions after a snapshot: as they are, unless Type-1 columns are
    restated in all versions."""
    if not spec.type1 or spec.type1_scope != "all":
        return closed.select(*spec.columns)
    return restate_type1(closed, snapshot, spec, tuple(spec.type1)).select(*spec.columns)


def merge_current(
    current: DataFrame | None,
    snapshot: DataFrame,
    as_of: dt.date,
    spec: Scd2Spec,
    validate: bool = True,
    start_key: int = 1,
) -> MergeResult:
    """:func:`merge_snapshot` on the open versions alone. ``dimension`` holds
    ``current`` (the open versions afterwards) and ``closed`` (those closed now)."""
    nk = spec.natural_key
    snap = snapshot.select(nk, *spec.attributes)
    snap_rows = validate_members(snap, nk) if validate else None
    dim = empty_dimension(snap, spec) if current is None else current
    start = start_key
    snap = snap.withColumn("_in_s", F.lit(True))
    dim = dim.withColumn("_in_d", F.lit(True))

    d, s = dim.alias("d"), snap.alias("s")
    j = d.join(s, F.col(f"d.{nk}") == F.col(f"s.{nk}"), "full_outer")
    has_d = F.col("d._in_d").isNotNull()
    has_s = F.col("s._in_s").isNotNull()
    cur = F.coalesce(F.col(f"d.{spec.is_current}"), F.lit(False))
    changed = any_changed_cols((F.col(f"d.{c}"), F.col(f"s.{c}")) for c in spec.tracked)
    expire = has_d & has_s & cur & changed
    reject = expire & (F.lit(as_of) <= F.col(f"d.{spec.valid_from}"))
    as_of_lit = F.lit(as_of).cast("date")
    member = F.coalesce(F.col(f"d.{nk}"), F.col(f"s.{nk}"))

    def carried_attr(c: str) -> Column:
        if c in spec.type1:
            restate = has_s & (F.lit(spec.type1_scope == "all") | (cur & ~expire))
            return F.when(restate, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}"))
        return F.col(f"d.{c}")

    existing = F.struct(
        F.col(f"d.{spec.key}").alias(spec.key),
        member.alias(nk),
        *[carried_attr(c).alias(c) for c in spec.attributes],
        F.col(f"d.{spec.valid_from}").alias(spec.valid_from),
        F.when(expire, as_of_lit).otherwise(F.col(f"d.{spec.valid_to}")).alias(spec.valid_to),
        F.when(expire, F.lit(False)).otherwise(F.col(f"d.{spec.is_current}")).alias(spec.is_current),
        F.col(f"d.{spec.version}").alias(spec.version),
        F.when(reject, "rejected")
        .when(expire, "expired")
        .when(cur & has_s, "unchanged")
        .otherwise("carried")
        .alias(_ACTION),
    )
    opened = F.struct(
        F.lit(None).cast("long").alias(spec.key),
        member.alias(nk),
        *[F.col(f"s.{c}").alias(c) for c in spec.attributes],
        as_of_lit.alias(spec.valid_from),
        F.lit(END_OF_TIME).cast("date").alias(spec.valid_to),
        F.lit(True).alias(spec.is_current),
        (F.coalesce(F.col(f"d.{spec.version}"), F.lit(0)) + 1).cast("int").alias(spec.version),
        F.when(has_d, "versioned").otherwise("inserted").alias(_ACTION),
    )
    rows = F.array(F.when(has_d, existing), F.when(~has_d | expire, opened))
    merged = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")
    merged = cut_lineage(merged, "scd2-merge")

    counts = {r[_ACTION]: r["n"] for r in merged.groupBy(_ACTION).agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts.get("rejected"):
        bad = merged.where(F.col(_ACTION) == "rejected").select(nk).limit(_MAX_LISTED).collect()
        raise SnapshotRejected(
            f"snapshot {as_of} changes members whose current version starts on or after it: "
            + ", ".join(str(r[0]) for r in bad)
        )
    done = {action: counts.get(action, 0) for action in ACTIONS}
    classified = sum(done.values())
    if snap_rows is not None and classified != snap_rows:
        # a member in the dimension with no current version, or with two
        raise SnapshotRejected(
            f"snapshot {as_of}: {snap_rows} members but {classified} classified; "
            "the dimension must hold exactly one current version per member"
        )
    rows = sum(counts.values())
    kept = merged.where(F.col(spec.key).isNotNull() & (F.col(_ACTION) != "expired")).drop(_ACTION)
    closed = merged.where(F.col(_ACTION) == "expired").select(*spec.columns)
    new = merged.where(F.col(spec.key).isNull()).drop(_ACTION, spec.key)
    n_new = done["inserted"] + done["versioned"]
    if n_new == 0:
        now = kept.select(*spec.columns)
        return MergeResult(now, done, rows=rows, next_key=start, current=now, closed=closed)
    # the exact number of new versions sizes the range partitioning (one
    # partition needs no sampling pass)
    parts = -(-n_new // _ROWS_PER_KEY_PARTITION)
    keyed = assign_dense_keys(new, [nk], spec.key, start=start, partitions=parts)
    now = kept.unionByName(keyed).select(*spec.columns)
    return MergeResult(
        now.unionByName(closed), done, rows=rows, next_key=start + n_new, current=now, closed=closed
    )


def replay_snapshots(
    snapshots: DataFrame,
    spec: Scd2Spec,
    as_of_col: str = "as_of",
    dim: DataFrame | None = None,
    dates: list[dt.date] | None = None,
) -> MergeResult:
    """K4: apply stacked snapshots oldest first with :func:`merge_snapshot`."""
    if dates is None:
        dates = sorted(r[0] for r in snapshots.select(as_of_col).distinct().collect())
    history: list[tuple[dt.date, dict[str, int]]] = []
    done = dict.fromkeys(ACTIONS, 0)
    if dim is not None and dates:
        first = merge_snapshot(dim, snapshots.where(F.col(as_of_col) == F.lit(dates[0])), dates[0], spec)
        history.append((dates[0], first.counts))
        done, dim, dates, start = first.counts, first.dimension, dates[1:], first.next_key
        is_open = F.coalesce(F.col(spec.is_current), F.lit(False))
        current, closed = dim.where(is_open), dim.where(~is_open)
    elif dim is not None:
        return MergeResult(dim, done, history)
    else:
        current, closed, start = None, None, 1
    for d in dates:
        snap = snapshots.where(F.col(as_of_col) == F.lit(d))
        res = merge_current(current, snap, d, spec, start_key=start)
        if closed is not None:
            closed = restate_closed(closed, snap, spec).unionByName(res.closed)
        else:
            closed = res.closed
        current, done, start = res.current, res.counts, res.next_key
        history.append((d, done))
    if current is None:
        empty = empty_dimension(snapshots.select(spec.natural_key, *spec.attributes), spec)
        return MergeResult(empty, done, history, 0)
    rows = start - 1 if dim is None else None  # keys are dense from 1
    return MergeResult(current.unionByName(closed), done, history, rows, start, current, closed)


# ---------------------------------------------------------------------------
# K5: whole-history rebuild (set-based equivalent of the replay)
# ---------------------------------------------------------------------------
def version_rows(snapshots: DataFrame, spec: Scd2Spec, as_of_col: str = "as_of") -> DataFrame:
    """Version rows (without surrogate keys) from stacked snapshots.

    A snapshot row opens a version when it is the member's first or when a
    tracked attribute differs (NULL-safely) from the member's previous
    snapshot row, which always carries the current version's values.
    One shuffle on the natural key; each window partition holds one member's
    snapshot rows only.
    """
    nk = spec.natural_key
    w = Window.partitionBy(nk).orderBy(as_of_col)
    opens = F.lag(as_of_col).over(w).isNull() | any_changed_cols(
        (F.col(c), F.lag(c).over(w)) for c in spec.tracked
    )
    base = snapshots.select(nk, as_of_col, *spec.attributes).withColumn("_opens", opens)
    if spec.type1:
        t1 = F.struct(*spec.type1)
        if spec.type1_scope == "all":
            whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            base = base.withColumn("_t1", F.last(t1).over(whole))
        else:
            base = base.withColumn("_vid", F.sum(F.col("_opens").cast("int")).over(w))
            wv = (
                Window.partitionBy(nk, "_vid")
                .orderBy(as_of_col)
                .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            )
            base = base.withColumn("_t1", F.last(t1).over(wv))
    nxt = F.lead(as_of_col).over(w)
    attrs = [
        (F.col(f"_t1.{c}") if c in spec.type1 else F.col(c)).alias(c) for c in spec.attributes
    ]
    return base.where("_opens").select(
        nk,
        *attrs,
        F.col(as_of_col).cast("date").alias(spec.valid_from),
        F.coalesce(nxt, F.lit(END_OF_TIME)).cast("date").alias(spec.valid_to),
        nxt.isNull().alias(spec.is_current),
        F.row_number().over(w).cast("int").alias(spec.version),
    )


def rebuild_history_counted(
    snapshots: DataFrame,
    spec: Scd2Spec,
    as_of_col: str = "as_of",
    start_key: int = 1,
    validate: bool = True,
) -> Keyed:
    """K5: the dimension a replay of all snapshots would produce, in one pass.

    Keys follow (valid_from, natural key), the order a replay assigns them.
    """
    parts = None
    if validate:
        # versions never outnumber snapshot rows: a proven bound sizes the numbering
        n = validate_members(snapshots, spec.natural_key, as_of_col)
        parts = max(1, -(-n // _ROWS_PER_KEY_PARTITION))
    versions = version_rows(snapshots, spec, as_of_col)
    keyed = dense_keys(versions, [spec.valid_from, spec.natural_key], spec.key, start=start_key, partitions=parts)
    return Keyed(keyed.df.select(*spec.columns), keyed.rows)


def rebuild_history(
    snapshots: DataFrame,
    spec: Scd2Spec,
    as_of_col: str = "as_of",
    start_key: int = 1,
    validate: bool = True,
) -> DataFrame:
    """:func:`rebuild_history_counted` without the row count."""
    return rebuild_history_counted(snapshots, spec, as_of_col, start_key, validate).df


def load_statistics(
    snapshots: DataFrame, spec: Scd2Spec, as_of_col: str = "as_of", validate: bool = True
) -> DataFrame:
    """K6 for every stacked snapshot at once: inserted / versioned / unchanged.

    Same classification as the merge, computed with one window pass.
    """
    if validate:
        validate_members(snapshots, spec.natural_key, as_of_col)
    nk = spec.natural_key
    w = Window.partitionBy(nk).orderBy(as_of_col)
    first = F.lag(as_of_col).over(w).isNull()
    changed = any_changed_cols((F.col(c), F.lag(c).over(w)) for c in spec.tracked)
    action = F.when(first, "inserted").when(changed, "versioned").otherwise("unchanged")
    tagged = snapshots.select(as_of_col, action.alias(_ACTION))
    return tagged.groupBy(as_of_col).agg(
        F.count_if(F.col(_ACTION) == "inserted").cast("bigint").alias("inserted"),
        F.count_if(F.col(_ACTION) == "versioned").cast("bigint").alias("versioned"),
        F.count_if(F.col(_ACTION) == "unchanged").cast("bigint").alias("unchanged"),
    )


# ---------------------------------------------------------------------------
# Type 1
# ---------------------------------------------------------------------------
def type1_rebuild(
    snapshots: DataFrame,
    natural_key: str,
    attributes: tuple[str, ...],
    key: str,
    as_of_col: str = "as_of",
) -> DataFrame:
    """Pure Type-1 dimension: one row per member with its latest values.

    Keys follow first appearance (first as_of, then natural key), the order
    in which incremental loads would have drawn them.
    """
    n = validate_members(snapshots, natural_key, as_of_col)
    latest = F.max_by(F.struct(*attributes), F.col(as_of_col))
    members = snapshots.groupBy(natural_key).agg(
        F.min(as_of_col).alias("_first_seen"), latest.alias("_v")
    )
    members = members.select(natural_key, "_first_seen", *[F.col(f"_v.{c}").alias(c) for c in attributes])
    parts = max(1, -(-n // _ROWS_PER_KEY_PARTITION))  # members never outnumber snapshot rows
    keyed = assign_dense_keys(members, ["_first_seen", natural_key], key, partitions=parts)
    return keyed.select(key, natural_key, *attributes)


def type1_merge(
    dim: DataFrame | None,
    snapshot: DataFrame,
    natural_key: str,
    attributes: tuple[str, ...],
    key: str,
) -> DataFrame:
    """Incremental Type-1 load: overwrite in place, new members get new keys."""
    snap = snapshot.select(natural_key, *attributes)
    validate_members(snap, natural_key)
    if dim is None:
        return assign_dense_keys(snap, [natural_key], key).select(key, natural_key, *attributes)
    start = next_key(dim, key)
    d, s = dim.alias("d"), snap.alias("s")
    j = d.join(s, F.col(f"d.{natural_key}") == F.col(f"s.{natural_key}"), "full_outer")
    has_s = F.col(f"s.{natural_key}").isNotNull()
    out = j.select(
        F.col(f"d.{key}").alias(key),
        F.coalesce(F.col(f"d.{natural_key}"), F.col(f"s.{natural_key}")).alias(natural_key),
        *[F.when(has_s, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in attributes],
    )
    out = cut_lineage(out, "scd-merge")
    new = out.where(F.col(key).isNull()).drop(key)
    keyed = assign_dense_keys(new, [natural_key], key, start=start)
    return out.where(F.col(key).isNotNull()).unionByName(keyed.select(*out.columns))


def restate_type1(dim: DataFrame, corrections: DataFrame, spec: Scd2Spec, columns: tuple[str, ...]) -> DataFrame:
    """D1 on a versioned dimension: overwrite ``columns`` from ``corrections``.

    ``type1_scope == "all"`` restates every version of a corrected member;
    ``"current"`` touches the open version only.
    """
    nk = spec.natural_key
    fix = corrections.select(nk, F.lit(True).alias("_fix"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    j = dim.join(fix, nk, "left")
    hit = F.coalesce(F.col("_fix"), F.lit(False))  # a correction row exists (its values may be NULL)
    if spec.type1_scope != "all":
        hit = hit & F.col(spec.is_current)
    return j.select(
        *[
            (F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) if c in columns else F.col(c)).alias(c)
            for c in dim.columns
        ]
    )


# ---------------------------------------------------------------------------
# Type 3 (previous-value column)
# ---------------------------------------------------------------------------
def type3_rebuild(
    snapshots: DataFrame,
    natural_key: str,
    attribute: str,
    key: str,
    as_of_col: str = "as_of",
) -> DataFrame:
    """One row per member: current value, the value before the latest change
    and the date of that change (NULL when it never changed)."""
    n = validate_members(snapshots, natural_key, as_of_col)
    w = Window.partitionBy(natural_key).orderBy(as_of_col)
    prev = F.lag(attribute).over(w)
    changed = F.lag(as_of_col).over(w).isNotNull() & ~F.col(attribute).eqNullSafe(prev)
    rows = snapshots.select(
        natural_key,
        as_of_col,
        attribute,
        prev.alias("_prev"),
        F.when(changed, F.col(as_of_col)).alias("_changed_on"),
    )
    members = rows.groupBy(natural_key).agg(
        F.min(as_of_col).alias("_first_seen"),
        F.max_by(attribute, as_of_col).alias(f"current_{attribute}"),
        F.max_by("_prev", "_changed_on").alias(f"previous_{attribute}"),
        F.max("_changed_on").cast("date").alias(f"{attribute}_changed_on"),
    )
    parts = max(1, -(-n // _ROWS_PER_KEY_PARTITION))
    keyed = assign_dense_keys(members, ["_first_seen", natural_key], key, partitions=parts)
    return keyed.select(
        key, natural_key, f"current_{attribute}", f"previous_{attribute}", f"{attribute}_changed_on"
    )


def type3_merge(
    dim: DataFrame | None,
    snapshot: DataFrame,
    as_of: dt.date,
    natural_key: str,
    attribute: str,
    key: str,
) -> DataFrame:
    """Incremental Type-3 load: on change, current moves to previous."""
    cur_c, prev_c, on_c = f"current_{attribute}", f"previous_{attribute}", f"{attribute}_changed_on"
    validate_members(snapshot, natural_key)
    snap = snapshot.select(natural_key, F.col(attribute).alias("_new"))
    if dim is None:
        first = snap.select(
            natural_key,
            F.col("_new").alias(cur_c),
            F.lit(None).cast(snapshot.schema[attribute].dataType).alias(prev_c),
            F.lit(None).cast("date").alias(on_c),
        )
        return assign_dense_keys(first, [natural_key], key).select(key, natural_key, cur_c, prev_c, on_c)
    start = next_key(dim, key)
    j = dim.alias("d").join(snap.alias("s"), F.col(f"d.{natural_key}") == F.col(f"s.{natural_key}"), "full_outer")
    has_d = F.col(f"d.{natural_key}").isNotNull()
    has_s = F.col(f"s.{natural_key}").isNotNull()
    moved = has_d & has_s & ~F.col(f"d.{cur_c}").eqNullSafe(F.col("s._new"))
    out = j.select(
        F.col(f"d.{key}").alias(key),
        F.coalesce(F.col(f"d.{natural_key}"), F.col(f"s.{natural_key}")).alias(natural_key),
        F.when(has_s, F.col("s._new")).otherwise(F.col(f"d.{cur_c}")).alias(cur_c),
        F.when(moved, F.col(f"d.{cur_c}")).otherwise(F.col(f"d.{prev_c}")).alias(prev_c),
        F.when(moved, F.lit(as_of).cast("date")).otherwise(F.col(f"d.{on_c}")).alias(on_c),
    )
    out = cut_lineage(out, "scd-merge")
    new = out.where(F.col(key).isNull()).drop(key)
    keyed = assign_dense_keys(new, [natural_key], key, start=start)
    return out.where(F.col(key).isNotNull()).unionByName(keyed.select(*out.columns))
