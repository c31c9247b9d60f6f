"""K8 warehouse build, K9 idempotency proof, S6/S9 persisted tables, D5 repair of
stored lines, D6 bounded-window reload and D24 month-partitioned fact.

Layout under ``root``::

    dim_<name>/v=<n>/       a static dimension: one committed folder per version
    dim_customer/v=<n>/     a Type-2 dimension: current/ (all open versions), closed/
                            (the versions that load n closed) and part.json
    stg_sales/              staging, overwritten each run
    fact_sales/             published month versions (plans/publish.py) of three
                            tables: sales; parked (lines waiting for a member); and
                            month_category, the sums that loads keep up to date

A dimension version counts only once it is committed (``_SUCCESS``, or ``part.json``,
which is written last), so a load that dies half way leaves the previous version live
and the re-run simply writes the same next version again. Closed versions are written
once; a version's ``part.json`` lists the folders that hold them. Loads of the
fact become visible by one publication, data and key ledger together.
"""

from __future__ import annotations

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import month_key
from starloom.operators.asof import lookup_key, lookup_versions, unknown_member_row
from starloom.operators.facts import preaggregate, resolve_keys
from starloom.operators.scd import SnapshotRejected, empty_dimension, merge_current, restate_closed
from starloom.plans.publish import (
    MONTH,
    Publication,
    by_month,
    filesystem,
    latest,
    new_load,
    publish,
    read_table,
    with_months,
    write_months,
)
from starloom.schemas import CUSTOMER_SPEC, END_OF_TIME, FACT_SALES_COLUMNS, SALE_KEY_ORDER, UNKNOWN_KEY, Scd2Spec
from starloom.session import checkpoint_dir, cut_lineage
from starloom.sources import star_inputs as src

FACT_PARTITION = MONTH
SALES, PARKED, ROLLUP = "sales", "parked", "month_category"
_PARTS = "part.json"
_fs = filesystem

#: What a parked line keeps, so that it can be looked up again.
PARKED_COLUMNS = ["sale_key", "date_key", "order_date", "product_id", "store_id", "customer_id"]


# --- dimensions -----------------------------------------------------------------
def committed_versions(spark: SparkSession, table_path: str) -> list[int]:
    fs, p, jvm = _fs(spark, table_path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        done = (jvm.org.apache.hadoop.fs.Path(st.getPath(), mark) for mark in ("_SUCCESS", _PARTS))
        if name.startswith("v=") and any(fs.exists(d) for d in done):
            out.append(int(name[2:]))
    return sorted(out)


@dataclass(frozen=True)
class Parts:
    """A Type-2 dimension's version in two parts: the load that wrote the open
    versions, the loads whose closed versions count, and the first free key."""

    version: int
    schema: str
    closed: list[int]
    next_key: int

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def current_path(self, table_path: str) -> str:
        return f"{table_path}/v={self.version}/current"

    def closed_paths(self, table_path: str) -> list[str]:
        return [f"{table_path}/v={n}/closed" for n in self.closed]


def dimension_parts(spark: SparkSession, table_path: str) -> Parts | None:
    """The live version's parts; None for a dimension that is stored whole, or not yet."""
    versions = committed_versions(spark, table_path)
    if not versions:
        return None
    fs, p, jvm = _fs(spark, f"{table_path}/v={versions[-1]}/{_PARTS}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return Parts(**json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def read_dimension(spark: SparkSession, table_path: str) -> DataFrame | None:
    """All versions of the live dimension, in one scan."""
    versions = committed_versions(spark, table_path)
    if not versions:
        return None
    parts = dimension_parts(spark, table_path)
    if parts is None:
        return spark.read.parquet(f"{table_path}/v={versions[-1]}")
    paths = [parts.current_path(table_path), *parts.closed_paths(table_path)]
    return spark.read.schema(parts.struct()).parquet(*paths)


def read_current(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The open versions of a dimension stored in two parts; no closed one is read."""
    parts = dimension_parts(spark, table_path)
    return None if parts is None else spark.read.schema(parts.struct()).parquet(parts.current_path(table_path))


def _read_closed(spark: SparkSession, table_path: str, parts: Parts) -> DataFrame:
    if not parts.closed:
        return spark.createDataFrame([], parts.struct())
    return spark.read.schema(parts.struct()).parquet(*parts.closed_paths(table_path))


def write_dimension(df: DataFrame, table_path: str) -> int:
    """Write the next version of a dimension stored whole; it becomes current when
    the job commits."""
    versions = committed_versions(df.sparkSession, table_path)
    n = (versions[-1] + 1) if versions else 1
    df.write.mode("overwrite").parquet(f"{table_path}/v={n}")
    return n


class UnsafeVersion(RuntimeError):
    """A new dimension version that breaks T3/T4; it is not published."""


def assert_publishable(dim: DataFrame, spec) -> None:
    """T3 + T4 on a version before it becomes visible: one current row per
    member, windows that tile, versions 1..n. Two small aggregate jobs."""
    from starloom.operators import checks as C

    bad = C.failures(
        C.metrics([C.one_current(dim, spec), C.tiling(dim, spec)]),
        {m: 0 for m in ("members_not_one_current", "gap", "last_not_open", "wrong_current", "empty_window", "version_hole")},
    )
    if bad:
        raise UnsafeVersion("; ".join(bad))


def assert_merge_publishable(current: DataFrame, closed: DataFrame, spec: Scd2Spec) -> None:
    """T3 + T4 for one merge, from its two small sides only: the open versions are
    one per member, open-ended and current, and each version closed now ends where
    its member's open version begins, as the version before it. What was closed
    earlier does not change, so it needs no second look."""
    nk, members = spec.natural_key, current.groupBy(spec.natural_key).agg(F.count(F.lit(1)).alias("_n"))
    twice = members.where(F.col("_n") > 1).count()
    wrong = current.where(
        ~F.coalesce(F.col(spec.is_current), F.lit(False))
        | (F.col(spec.valid_to) != F.lit(END_OF_TIME))
        | (F.col(spec.valid_from) >= F.col(spec.valid_to))
    ).count()
    now = current.select(
        F.col(nk).alias("_nk"), F.col(spec.valid_from).alias("_from"), F.col(spec.version).alias("_version")
    )
    fits = (F.col(spec.valid_to) == F.col("_from")) & (F.col(spec.version) + 1 == F.col("_version"))
    loose = closed.join(now, F.col(nk) == F.col("_nk"), "left").where(
        ~F.coalesce(fits, F.lit(False)) | (F.col(spec.valid_from) >= F.col(spec.valid_to)) | F.col(spec.is_current)
    )
    found = {"members_not_one_current": twice, "wrong_current": wrong, "gap": loose.count()}
    if any(found.values()):
        raise UnsafeVersion("; ".join(f"{k}: expected 0, got {v}" for k, v in found.items() if v))


def merge_into(
    spark: SparkSession,
    table_path: str,
    snapshot: DataFrame,
    as_of: dt.date,
    spec: Scd2Spec,
    seed: bool = False,
):
    """K2 on a stored dimension: merge a snapshot into its open versions, append the
    versions it closes, and commit both by one small file. Closed versions of
    earlier loads are not read, unless Type-1 columns are restated in all of
    them. A load that changes nothing writes nothing. A dimension stored whole
    is taken apart by its first merge. ``seed`` stores the unknown member's
    row with the first version."""
    parts, versions = dimension_parts(spark, table_path), committed_versions(spark, table_path)
    n = (versions[-1] + 1) if versions else 1
    folder, earlier, old_closed = f"{table_path}/v={n}", [], None
    current, start = None, 1
    if parts is not None:
        current, earlier, start = read_current(spark, table_path), parts.closed, parts.next_key
    elif versions:
        whole = read_dimension(spark, table_path)
        is_open = F.coalesce(F.col(spec.is_current), F.lit(False))
        current, old_closed = whole.where(is_open), whole.where(~is_open)
        start = max(0, whole.agg(F.max(spec.key)).first()[0] or 0) + 1
        stray = old_closed.join(current.select(spec.natural_key), spec.natural_key, "left_anti").select(spec.natural_key)
        lost = stray.distinct().count()
        if lost:
            raise SnapshotRejected(f"{lost} members have closed versions only, not exactly one current version")
    res = merge_current(current, snapshot, as_of, spec, start_key=start)
    # a correction of a Type-1 column opens no version, but is to be stored
    restated = bool(spec.type1) and current is not None and not res.current.exceptAll(current.select(*spec.columns)).isEmpty()
    if not res.changed and versions and not restated:
        return res
    if seed and not versions:
        member = unknown_member_row(empty_dimension(snapshot, spec), spec, spec.key)
        member = member.withColumn(spec.version, F.lit(1).cast("int")).select(*spec.columns)
        res.current = res.current.unionByName(member)
    assert_merge_publishable(res.current, res.closed, spec)
    closing = res.closed
    if parts is not None and spec.type1 and spec.type1_scope == "all":
        # restated in every version: all closed parts are written anew, in this load's folder
        closing = restate_closed(_read_closed(spark, table_path, parts), snapshot, spec).unionByName(closing)
        earlier = []
    elif old_closed is not None:
        closing = restate_closed(old_closed, snapshot, spec).unionByName(closing)
    res.current.write.mode("overwrite").parquet(f"{folder}/current")
    closing.write.mode("overwrite").parquet(f"{folder}/closed")
    schema = spark.read.parquet(f"{folder}/current").schema
    state = Parts(n, schema.json(), [*earlier, n], res.next_key)
    fs, mark, _ = _fs(spark, f"{folder}/{_PARTS}")
    draft = mark.suffix(".draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(state.__dict__).encode()))
    finally:
        stream.close()
    if not fs.rename(draft, mark):
        raise RuntimeError(f"{folder} could not be committed")
    res.dimension = read_dimension(spark, table_path)
    return res


# --- the fact's month versions -------------------------------------------------------
def _with_month(rows: DataFrame, date_col: str = "date_key") -> DataFrame:
    part = (F.col(date_col) / 100).cast("int") if date_col == "date_key" else month_key(date_col)
    return rows.withColumn(FACT_PARTITION, part)


def fact_by_month(fact: DataFrame, date_col: str = "date_key") -> DataFrame:
    """The fact dealt out by month, for several calls of :func:`write_fact` with ``clustered``."""
    return by_month(_with_month(fact, date_col)).drop(FACT_PARTITION)


def write_fact(
    fact: DataFrame, path: str, date_col: str = "date_key", whole: bool = False, clustered: bool = False
) -> None:
    """S6 + D24: the fact partitioned by month. Only months present in ``fact`` are
    replaced, unless it is the ``whole`` fact: then no month of an earlier load
    stays live. Readers see the old months until all new ones are written."""
    spark = fact.sparkSession
    before = latest(spark, path)
    rows, load = _with_month(fact, date_col), new_load(before)
    written = write_months(rows, path, SALES, load, clustered=clustered)
    publish(
        spark, path, with_months(before, SALES, load, written, lambda m: whole or m in written, rows.schema)
    )


class OutsideWindow(ValueError):
    """Rows of a reload that are not dated inside its window."""


def _window(first: dt.date, last: dt.date):
    lo, hi = (int(d.strftime("%Y%m%d")) for d in (first, last))
    inside = F.coalesce(F.col("date_key").between(lo, hi), F.lit(False))
    return inside, lambda month: month.isdigit() and lo // 100 <= int(month) <= hi // 100


def _replace_window(
    spark: SparkSession,
    path: str,
    before: Publication,
    tables: dict[str, DataFrame],
    first: dt.date,
    last: dt.date,
    load: str,
) -> Publication:
    """Write the window's months anew for each table: its rows of these dates, and the
    live rows of the same months outside the window. Returns what is to be published."""
    inside, in_months = _window(first, last)
    after = before
    for table, fresh in tables.items():
        rows = _with_month(fresh)
        months = {m for m in before.months.get(table, {}) if in_months(m)}
        kept = read_table(spark, path, table, before, months)
        if kept is not None:
            cols = [c for c in fresh.columns if c != FACT_PARTITION]
            rows = _with_month(kept.where(~inside).select(*cols).unionByName(fresh.select(*cols)))
        written = write_months(rows, path, table, load)
        after = with_months(after, table, load, written, in_months, rows.schema)
    return after


def reload_window(fact_rows: DataFrame, path: str, first: dt.date, last: dt.date) -> None:
    """Delete and re-insert the business dates [first, last].

    ``fact_rows`` replace the stored rows of those dates; stored rows of the same
    months outside the window are kept. Rows dated outside the window (or not at
    all) are refused with their number, before anything is written. All months
    of the window change by one switch, months left without a row go by the same
    one, and a repeat changes nothing. A reload that dies leaves the fact as it was,
    and of two that overlap in time the second is refused.
    """
    spark = fact_rows.sparkSession
    cols = [c for c in fact_rows.columns if c != FACT_PARTITION]
    fresh = cut_lineage(fact_rows.select(*cols), "window-rows")
    inside, _ = _window(first, last)
    outside = fresh.where(~inside).count()
    if outside:
        raise OutsideWindow(f"{outside} rows are not dated from {first} to {last}")
    before = latest(spark, path)
    publish(spark, path, _replace_window(spark, path, before, {SALES: fresh}, first, last, new_load(before)))


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    fact = read_table(spark, path, SALES, latest(spark, path))
    if fact is None:
        raise FileNotFoundError(f"{path} has no published fact")
    return fact


def read_parked(spark: SparkSession, path: str) -> DataFrame | None:
    """The lines that wait for a member, with their natural keys and dates."""
    return read_table(spark, path, PARKED, latest(spark, path))


@dataclass
class BuildStats:
    products: int
    stores: int
    customers: int
    customer_versions: int
    fact_rows: int
    scd_loads: list[dict[str, int]]  # members per action, one entry per load


FACT_ROWS_PER_KEY_PARTITION = 5_000_000


class UnsafeLoad(RuntimeError):
    """Resolved lines that break T1/T2; the fact stays as it was."""


def _key_hash(key: Column) -> Column:
    return F.sum(F.xxhash64(key).cast("decimal(38,0)"))


def assert_loadable(
    lines: DataFrame, dims: dict[str, DataFrame], staged: int, mode: str, start: int, rows: int, key: str = "sale_key"
) -> None:
    """T1 + T2 before lines are published: as many as were
    staged, a dimension row for each key, and keys that are exactly the batch's range.
    Their number, bounds and hash sum are compared with those of the range, so no
    key is shuffled to be found unique. Grain keys that the source itself repeats are
    loaded as they come; [check_grain] counts them."""
    spark = lines.sparkSession
    got = lines.agg(
        F.count(F.lit(1)).alias("fact_lines"),
        F.min(key).alias("least"),
        F.max(key).alias("most"),
        _key_hash(F.col(key)).alias("hashed"),
    ).first()
    # each key's own column alone, its lines counted before they meet the dimension
    looked_up = []
    for k, dim in dims.items():
        used = lines.groupBy(F.col(k).alias("_used")).agg(F.count(F.lit(1)).alias("_lines"))
        known = dim.select(F.col(k).alias("_known"))
        met = used.join(known, F.col("_used") == F.col("_known"), "left")
        lost = F.sum(F.when(F.col("_known").isNull(), F.col("_lines")).otherwise(F.lit(0)))
        looked_up.append(met.agg(F.lit(k).alias("key"), F.sum("_lines").alias("met"), lost.alias("lost")))
    by_key = {r["key"]: r for r in reduce(DataFrame.unionByName, looked_up).collect()} if looked_up else {}
    want = spark.range(start, start + rows).agg(_key_hash(F.col("id")).alias("hashed")).first()
    bad = [f"orphan_{k}: expected 0, got {r['lost']}" for k, r in by_key.items() if r["lost"]]
    # a dimension row that comes twice would double its lines
    for n in dict.fromkeys([got["fact_lines"], *(r["met"] or 0 for r in by_key.values())]):
        if n != staged:
            bad.append(f"fact_lines: expected {staged}, got {n}")
    keys = (got["fact_lines"], got["least"], got["most"], got["hashed"])
    if rows and keys != (rows, start, start + rows - 1, want["hashed"]):
        bad.append(f"{key}: not the keys {start} to {start + rows - 1}, each once")
    if bad:
        raise UnsafeLoad(f"mode {mode}: " + "; ".join(bad))


def seeded_dimension(spark: SparkSession, path: str, spec, key: str) -> DataFrame:
    """The live version, with the unknown member's row (D4) stored in it; as
    the only version of its member it is number 1, so T3/T4 hold."""
    dim = read_dimension(spark, path)
    if not dim.where(F.col(key) == UNKNOWN_KEY).isEmpty():
        return dim
    seed = unknown_member_row(dim, spec, key)
    if spec is not None:
        seed = seed.withColumn(spec.version, F.lit(1).cast(dim.schema[spec.version].dataType))
    write_dimension(dim.unionByName(seed), path)
    return read_dimension(spark, path)


def _load_dimensions(spark: SparkSession, out: str, mode: str) -> dict[str, DataFrame]:
    """The live dimensions by fact key, seeded for the unknown mode."""
    named = {"product": None, "store": None, "customer": CUSTOMER_SPEC}
    dims = {}
    for n, spec in named.items():
        path, key = f"{out}/dim_{n}", f"{n}_key"
        dims[key] = seeded_dimension(spark, path, spec, key) if mode == "unknown" else read_dimension(spark, path)
    return dims | {"date_key": spark.read.parquet(f"{out}/dim_date")}


_BUCKET, _POS = "_bucket", "_pos"
MAX_BROADCAST_BUCKETS = 200_000


def number_lines(lines: DataFrame, staged_rows: dict[str, int], order=SALE_KEY_ORDER) -> DataFrame:
    """K1 by month: every line's place in its month, materialised by one pass.

    A month is cut into buckets of about ``FACT_ROWS_PER_KEY_PARTITION`` lines by
    a hash of the whole ``order``, and lines are numbered inside a bucket; nothing is
    sorted across buckets or months, and nothing is sampled. ``staged_rows`` bounds
    the lines of each month. Bucket and place depend on the lines alone, not on
    how Spark dealt them out, so equal batches are numbered alike.
    """
    many = {m: -(-n // FACT_ROWS_PER_KEY_PARTITION) for m, n in staged_rows.items() if n > FACT_ROWS_PER_KEY_PARTITION}
    bucket = F.lit(0)
    if many:
        buckets = F.create_map(*[F.lit(x) for m, n in many.items() for x in (int(m), n)])
        bucket = F.pmod(F.xxhash64(*order), F.coalesce(buckets[F.col(MONTH)], F.lit(1))).cast("int")
    places = Window.partitionBy(MONTH, _BUCKET).orderBy(*order)
    numbered = _with_month(lines).withColumn(_BUCKET, bucket).withColumn(_POS, F.row_number().over(places).cast("long"))
    return cut_lineage(numbered, "numbered-lines")


def keyed_lines(numbered: DataFrame, starts: dict[str, int], key: str = "sale_key") -> DataFrame:
    """Keys from the months' first keys, the buckets' offsets and the places."""
    month_start = F.create_map(*[F.lit(x) for m, at in starts.items() for x in (int(m), at)]) if starts else None
    first = month_start[F.col(MONTH)] if starts else F.lit(1)
    counts = numbered.groupBy(MONTH, _BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
    n, most = counts.agg(F.count(F.lit(1)), F.max(_BUCKET)).first()
    offset = F.lit(0)
    if most:
        before = Window.partitionBy(MONTH).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(MONTH, _BUCKET, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
        numbered = numbered.join(
            F.broadcast(offsets) if n <= MAX_BROADCAST_BUCKETS else offsets, [MONTH, _BUCKET]
        )
        offset = F.col("_offset")
    value = (first + offset + F.col(_POS) - 1).cast("long").alias(key)
    return numbered.select(value, *[F.col(c) for c in numbered.columns if c not in (_BUCKET, _POS, "_offset", key)])


def _months_of(rows: DataFrame) -> dict[str, int]:
    """Rows by month: as many entries as the data spans months."""
    return {str(r[0]): r[1] for r in rows.groupBy(MONTH).agg(F.count(F.lit(1))).collect()}


def _with_rollup(
    spark: SparkSession, path: str, after: Publication, load: str, dims: dict[str, DataFrame], replaced
) -> Publication:
    """D18 kept with the fact: the month x category sums of the months that a load
    wrote, from those months alone; all other months keep theirs. Published with the
    lines, so the two never differ."""
    months = {m for m, live in after.months[SALES].items() if live == load}
    lines = read_table(spark, path, SALES, after, months)
    calendar = dims["date_key"].select("date_key", "year_month")
    cats = dims["product_key"].select("product_key", "category")
    sums = preaggregate(lines, calendar, cats, by=(MONTH,))
    written = write_months(sums, path, ROLLUP, load)
    return with_months(after, ROLLUP, load, written, replaced, sums.schema)


def read_rollup(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored month x category sums, one row each."""
    rows = read_table(spark, path, ROLLUP, latest(spark, path))
    return None if rows is None else rows.drop(MONTH)


def _install(
    spark: SparkSession,
    out: str,
    stg: DataFrame,
    batch: str,
    window: tuple[dt.date, dt.date] | None,
    mode: str,
    columns=tuple(FACT_SALES_COLUMNS),
) -> int:
    """Resolve staged lines once, number them from the ledger, check them, and publish
    them as the whole fact or as the dates of ``window``; returns their number."""
    path, dims = f"{out}/fact_sales", _load_dimensions(spark, out, mode)
    before = latest(spark, path)
    staged = _months_of(stg.select(month_key("order_date").alias(MONTH)))
    resolved = resolve_keys(stg, dims["product_key"], dims["store_key"], dims["customer_key"], mode)
    numbered = number_lines(resolved, staged)
    rows = _months_of(numbered)
    ledger = before if window else replace(before, next_key=1, batches={})
    start, starts, after = ledger.key_range(batch, rows)
    lines = keyed_lines(numbered, starts)
    if window:
        inside, _ = _window(*window)
        outside = lines.where(~inside).count()
        if outside:
            raise OutsideWindow(f"{outside} rows are not dated from {window[0]} to {window[1]}")
    assert_loadable(lines, dims, sum(staged.values()), mode, start, sum(rows.values()))
    waiting = F.lit(False)
    for key in ("product_key", "store_key", "customer_key"):
        waiting = waiting | (F.col(key) == UNKNOWN_KEY)
    tables = {SALES: lines.select(*columns), PARKED: lines.where(waiting).select(*PARKED_COLUMNS)}
    load = new_load(before)
    if window:
        after = _replace_window(spark, path, after, tables, *window, load)
        publish(spark, path, _with_rollup(spark, path, after, load, dims, _window(*window)[1]))
    else:
        for table, fresh in tables.items():
            months = _with_month(fresh)
            after = with_months(after, table, load, write_months(months, path, table, load), lambda m: True, months.schema)
        publish(spark, path, _with_rollup(spark, path, after, load, dims, lambda m: True))
    return sum(rows.values())


def repair_parked(spark: SparkSession, out: str) -> int:
    """D5 on the stored fact: look parked lines up again and give those whose member
    has arrived its key; returns how many lines changed.

    Only the months that hold such lines are read and written anew; all others keep
    their files. A line takes the version in force on its date, or the
    member's first version if that starts later (the member existed, the
    warehouse learnt of it late). Lines that still miss a member stay parked.
    Repeating it changes nothing.
    """
    path = f"{out}/fact_sales"
    before = latest(spark, path)
    parked = read_table(spark, path, PARKED, before)
    if parked is None:
        return 0
    dims = _load_dimensions(spark, out, "unknown")
    spec, customers = CUSTOMER_SPEC, dims["customer_key"]
    found = lookup_key(parked, dims["product_key"], "product_id", "product_id", "product_key", "unknown")
    found = lookup_key(found, dims["store_key"], "store_id", "store_id", "store_key", "unknown")
    found = lookup_versions(found, customers, spec, "customer_id", "order_date", "unknown", "_in_force")
    first = customers.where(F.col(spec.version) == 1).select(
        F.col(spec.natural_key).alias("_f_nk"), F.col(spec.key).alias("_f_key"), F.col(spec.valid_from).alias("_f_from")
    )
    found = found.join(first, (F.col("customer_id") == F.col("_f_nk")) & (F.col("order_date") < F.col("_f_from")), "left")
    in_force = F.col("_in_force")
    customer = F.when(in_force != UNKNOWN_KEY, in_force).otherwise(F.coalesce("_f_key", F.lit(UNKNOWN_KEY).cast("long")))
    keys = ["product_key", "store_key", "customer_key"]
    found = cut_lineage(
        found.select(*PARKED_COLUMNS, MONTH, "product_key", "store_key", customer.alias("customer_key")), "parked-again"
    )
    known = read_table(spark, path, SALES, before, set(before.months.get(PARKED, {})))
    told = found.select(F.col("sale_key").alias("_sale"), F.col(MONTH).alias("_month"), *[F.col(k).alias(f"_{k}") for k in keys])
    same_line = (F.col(MONTH) == F.col("_month")) & (F.col("sale_key") == F.col("_sale"))
    # a line that misses no member is not looked at again
    misses = F.coalesce(F.array_contains(F.array(*keys), F.lit(UNKNOWN_KEY).cast("long")), F.lit(False))
    stale = known.where(misses).join(told, same_line)
    better = [(F.col(k) == UNKNOWN_KEY) & (F.col(f"_{k}") != UNKNOWN_KEY) for k in keys]
    gained = stale.where(better[0] | better[1] | better[2])
    gained = cut_lineage(gained.select(MONTH, "sale_key", F.coalesce(better[0], F.lit(False)).alias("_moved")), "repaired-lines")
    touched = _months_of(gained)
    if not touched:
        return 0
    lines = read_table(spark, path, SALES, before, set(touched))
    repaired = lines.where(misses).join(told, same_line, "left").select(
        *[
            (F.when(F.col(c) == UNKNOWN_KEY, F.coalesce(f"_{c}", c)).otherwise(F.col(c)) if c in keys else F.col(c)).alias(c)
            for c in lines.columns
        ]
    )
    repaired = lines.where(~misses).unionByName(repaired)
    still = found.where(F.col(MONTH).isin([int(m) for m in touched]))
    still = still.where(F.greatest(*[(F.col(k) == UNKNOWN_KEY).cast("int") for k in keys]) == 1)
    load, after = new_load(before), before
    for table, rows in ((SALES, repaired), (PARKED, still.select(*PARKED_COLUMNS, MONTH))):
        written = write_months(rows, path, table, load)
        after = with_months(after, table, load, written, touched.__contains__, rows.schema)
    # a product that arrived moves its lines to a category; no other key is in the sums
    if ROLLUP in before.schemas and not gained.where("_moved").isEmpty():
        after = _with_rollup(spark, path, after, load, dims, touched.__contains__)
    publish(spark, path, after)
    return sum(touched.values())


def latest_load(dim: DataFrame) -> dt.date:
    """The newest ``valid_from``: every snapshot dated on or before it has
    been applied (loads run oldest first and the first one opens versions)."""
    return dim.agg(F.max(CUSTOMER_SPEC.valid_from).alias("m")).first()["m"]


def write_static_dimensions(spark: SparkSession, t, out: str, mode: str = "unknown") -> tuple[int, int]:
    """S3-S5 stored: calendar, products and stores; returns the members of the last two."""
    from starloom.operators.asof import with_unknown_member
    from starloom.operators.calendar import calendar
    from starloom.plans.star import order_date_span, product_dimension_counted, store_dimension_counted

    lo, hi = order_date_span(t)
    calendar(spark, lo, hi).write.mode("overwrite").parquet(f"{out}/dim_date")
    product, store = product_dimension_counted(t), store_dimension_counted(t)
    for name, keyed in (("product", product), ("store", store)):
        # the unknown member's row is part of the version, not a second one after it
        rows = with_unknown_member(keyed.df, None, f"{name}_key") if mode == "unknown" else keyed.df
        write_dimension(rows, f"{out}/dim_{name}")
    return product.rows, store.rows


def build(
    spark: SparkSession, sf_root: str, out: str, timings: dict | None = None, mode: str = "unknown"
) -> BuildStats:
    """K8: dimensions first (calendar, product, store, customer snapshots
    oldest first as Type 2), then staging, then the fact.

    Safe to re-run into the same ``out`` after a failure: static tables are
    overwritten, snapshots already applied are skipped, later ones re-apply
    as no-ops or as the missing loads. ``scd_loads`` lists the loads run now.
    Each customer version passes T3/T4, and the fact T1/T2, before it is
    published. ``mode="unknown"`` maps staged lines without a member to the
    seed rows stored in the dimensions; ``"inner"`` refuses to lose them.

    ``timings``, when given, receives seconds per step.
    """
    import time

    from starloom.sources.tables import Tables

    clock = time.perf_counter()

    def step(name: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        if timings is not None:
            timings[name] = round(now - clock, 3)
        clock = now

    t = Tables(spark, sf_root)
    checkpoint_dir(spark)  # resolve once, before jobs start from several threads

    # calendar, product and store load while the customer snapshots merge
    with ThreadPoolExecutor(max_workers=1) as pool:
        static = pool.submit(write_static_dimensions, spark, t, out, mode)
        snaps = src.customer_snapshots(t)
        loads: list[dict[str, int]] = []
        for d in src.SNAPSHOT_DATES:
            current = read_dimension(spark, f"{out}/dim_customer")
            if current is not None and d <= latest_load(current):
                continue  # applied before a crash: resume after the newest load
            snap = snaps.where(F.col("as_of") == F.lit(d))
            res = merge_into(spark, f"{out}/dim_customer", snap, d, CUSTOMER_SPEC, seed=mode == "unknown")
            loads.append(res.counts)
            step(f"scd2_merge_{d}")
        products, stores = static.result()
        step("dim_date_product_store")
    src.staged_sales(t).write.mode("overwrite").parquet(f"{out}/stg_sales")
    step("staging")
    _install(spark, out, spark.read.parquet(f"{out}/stg_sales"), "build", None, mode)
    step("fact")
    dim_customer = read_dimension(spark, f"{out}/dim_customer")
    f = read_fact(spark, f"{out}/fact_sales")
    counts = dim_customer.where(F.col("customer_key") != UNKNOWN_KEY).agg(
        F.count(F.lit(1)).alias("versions"), F.count_distinct("customer_id").alias("members")
    ).first()
    stats = BuildStats(
        products=products,
        stores=stores,
        customers=int(counts["members"]),
        customer_versions=int(counts["versions"]),
        fact_rows=f.count(),
        scd_loads=loads,
    )
    step("stats")
    return stats


def load_increment(
    spark: SparkSession,
    out: str,
    stg_batch: DataFrame,
    first: dt.date,
    last: dt.date,
    mode: str = "unknown",
    batch: str | None = None,
    columns: tuple[str, ...] = tuple(FACT_SALES_COLUMNS),
) -> int:
    """Load a staged batch covering the business dates [first, last].

    The batch is resolved once against the current dimensions, numbered from the key
    ledger (the history is not read) and installed like :func:`reload_window`, so
    re-running a batch replaces its dates instead of duplicating them, under the same
    keys if it is the same batch. ``batch`` names it in the ledger, by default its
    window; ``columns`` are those of the resolved lines that the fact keeps. Staged
    lines without a member get the unknown member and are parked
    (:func:`repair_parked`), or are refused in mode "inner"; T1/T2 run before
    anything is published. Returns the fact rows of the window after the load.
    """
    name = f"{batch or ''} {first} {last}".strip()
    return _install(spark, out, stg_batch, name, (first, last), mode, columns)


def open_star(spark: SparkSession, sf_root: str, out: str):
    """The persisted warehouse as a :class:`~starloom.plans.star.Star`.

    Row counts come from Parquet metadata and drive the broadcast bound;
    the fact keeps its ``month_key`` partition column for pruning.
    """
    from starloom.plans.star import Star
    from starloom.sources.tables import Tables

    dim_date = spark.read.parquet(f"{out}/dim_date")
    product = read_dimension(spark, f"{out}/dim_product")
    store = read_dimension(spark, f"{out}/dim_store")
    customer = read_dimension(spark, f"{out}/dim_customer")
    rows = {"product": product.count(), "store": store.count(), "customer": customer.count()}
    return Star(
        Tables(spark, sf_root),
        dim_date,
        product,
        store,
        customer,
        spark.read.parquet(f"{out}/stg_sales"),
        read_fact(spark, f"{out}/fact_sales"),
        dim_date.count(),
        rows,
    )


def idempotency_check(spark: SparkSession, sf_root: str, out: str) -> dict:
    """K9: re-apply the latest snapshot; a correct load changes nothing."""
    from starloom.sources.tables import Tables

    path = f"{out}/dim_customer"
    before = read_dimension(spark, path).count()
    last = src.SNAPSHOT_DATES[-1]
    snaps = src.customer_snapshots(Tables(spark, sf_root))
    res = merge_into(spark, path, snaps.where(F.col("as_of") == F.lit(last)), last, CUSTOMER_SPEC)
    after = read_dimension(spark, path).count()
    return {"rows_before": before, "rows_after": after, "load_stats": res.counts}
