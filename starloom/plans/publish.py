"""Published month versions: tables whose months are replaced by one switch.

Layout under a store's folder::

    <table>/load_id=<load>/month_key=<month>/   what a load wrote, never changed
    live/<n>.json                               publication n: the live load of each month

A load writes its months into a folder of its own, and then publishes: it puts one
small file that names, for every table and month, the load whose rows are live.
Readers take the publication with the highest number, so they see the old months
until that file stands and all new ones from then on, and a load that dies before
leaves nothing but files that no publication names. The file is moved into place
without overwriting; of two loads that started from one publication, the
second is refused (:class:`ConcurrentLoad`).

The publication also carries the store's key ledger: the first free key, and which
range of keys each batch took (:meth:`Publication.key_range`). A publication has one
entry per month and one per batch, no data.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import cut_lineage

MONTH = "month_key"
LOAD = "load_id"
MAX_RECORDS_PER_FILE = 5_000_000


class ConcurrentLoad(RuntimeError):
    """Another load published first; nothing of this one is live."""


@dataclass(frozen=True)
class Publication:
    """What is live. ``months``: load by table and month; ``batches``: the key range
    of each batch as [first key, {month: rows}]."""

    number: int = 0
    months: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    next_key: int = 1
    batches: dict[str, list] = field(default_factory=dict)

    def key_range(self, batch: str, rows: dict[str, int]) -> tuple[int, dict[str, int], Publication]:
        """The first key of a batch and of each of its months, and the ledger after
        it. A batch that comes again with as many rows in each month takes the range
        that it had; any other takes the next free keys."""
        known = self.batches.get(batch)
        start = known[0] if known and known[1] == rows else self.next_key
        starts, at = {}, start
        for month in sorted(rows):
            starts[month] = at
            at += rows[month]
        after = replace(self, next_key=max(self.next_key, at), batches=self.batches | {batch: [start, rows]})
        return start, starts, after


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _numbers(fs, folder) -> list[int]:
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _text(jvm, fs, path) -> str:
    stream = fs.open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def latest(spark: SparkSession, store: str) -> Publication:
    fs, folder, jvm = filesystem(spark, f"{store}/live")
    numbers = _numbers(fs, folder)
    if not numbers:
        return Publication()
    return Publication(**json.loads(_text(jvm, fs, jvm.org.apache.hadoop.fs.Path(folder, f"{numbers[-1]:08d}.json"))))


def publish(spark: SparkSession, store: str, after: Publication) -> Publication:
    """Make ``after`` live as the publication that follows the one it was made from."""
    after = replace(after, number=after.number + 1)
    fs, folder, jvm = filesystem(spark, f"{store}/live")
    hadoop = jvm.org.apache.hadoop.fs
    fs.mkdirs(folder)
    # a hidden name until all of it is written
    draft = hadoop.Path(folder, f".{after.number:08d}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(after.__dict__, sort_keys=True).encode()))
    finally:
        stream.close()
    final = hadoop.Path(folder, f"{after.number:08d}.json")
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), no_overwrite)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(final):
            raise ConcurrentLoad(f"publication {after.number} of {store} stands already; load again") from e
        raise
    return after


def new_load(after: Publication) -> str:
    """A load's folder name; unique, so files of a dead load are never met again."""
    return f"L{after.number + 1:08d}-{uuid.uuid4().hex[:12]}"


def by_month(rows: DataFrame, part: str = MONTH) -> DataFrame:
    """Rows that several loads write, dealt out by month once and kept so."""
    return cut_lineage(rows.hint("rebalance", part), "by-month", compression="zstd")


def write_months(
    rows: DataFrame, store: str, table: str, load: str, part: str = MONTH, clustered: bool = False
) -> set[str]:
    """Write a load's rows of one table, with their ``month_key``; returns its months.
    A table may be kept in parts by another column (text), such as a batch or a day.

    ``rebalance`` clusters rows by month so each task writes few partitions, while
    AQE splits a big month into advisory-sized tasks (a month is never funnelled
    through one task) and merges small ones. ``clustered`` rows (:func:`by_month`)
    are written as they lie.
    """
    spark = rows.sparkSession
    (
        (rows if clustered else rows.hint("rebalance", part))
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", "zstd")
        .partitionBy(part)
        .parquet(f"{store}/{table}/{LOAD}={load}")
    )
    fs, folder, _ = filesystem(spark, f"{store}/{table}/{LOAD}={load}")
    found = (st.getPath().getName().partition("=") for st in fs.listStatus(folder))
    return {month for name, _, month in found if name == part}


def with_months(
    before: Publication, table: str, load: str, written: set[str], replaced, schema: T.StructType, part: str = MONTH
) -> Publication:
    """``before`` with the written months live. ``replaced(month)`` says which months the
    load stands for: those it wrote nothing for are gone."""
    kept = {m: live for m, live in before.months.get(table, {}).items() if not replaced(m)}
    months = before.months | {table: kept | dict.fromkeys(written, load)}
    data = T.StructType([f for f in schema.fields if f.name != part])
    return replace(before, months=months, schemas=before.schemas | {table: data.json()})


def read_table(
    spark: SparkSession, store: str, table: str, live: Publication, months=None, part: str = MONTH
) -> DataFrame | None:
    """The table's live rows, with ``month_key``; of ``months`` only, when given. None
    if no load ever published it."""
    if table not in live.schemas:
        return None
    data = T.StructType.fromJson(json.loads(live.schemas[table]))
    key = T.StructField(part, T.IntegerType() if part == MONTH else T.StringType())
    shown = T.StructType([*data.fields, key])
    loads = live.months.get(table, {})
    paths = [
        f"{store}/{table}/{LOAD}={load}/{part}={month}"
        for month, load in sorted(loads.items())
        if months is None or month in months
    ]
    if not paths:
        return spark.createDataFrame([], shown)
    stored = T.StructType([*data.fields, T.StructField(LOAD, T.StringType()), key])
    found = spark.read.schema(stored).option("basePath", f"{store}/{table}").parquet(*paths)
    return found.select(*[F.col(f.name) for f in shown.fields])


def forget_old_loads(spark: SparkSession, store: str, keep: int = 2) -> list[str]:
    """Delete the folders of loads that none of the last ``keep`` publications names,
    and the publications before those. Run it when no load is under way; returns the
    deleted folders."""
    fs, folder, jvm = filesystem(spark, f"{store}/live")
    hadoop = jvm.org.apache.hadoop.fs
    numbers = _numbers(fs, folder)
    if not numbers:
        return []
    if keep < 1:
        raise ValueError("keep has to be 1 or more")
    needed, tables = set(), set()
    for n in numbers[-keep:]:
        seen = Publication(**json.loads(_text(jvm, fs, hadoop.Path(folder, f"{n:08d}.json"))))
        tables |= set(seen.schemas)
        needed |= {(table, load) for table, months in seen.months.items() for load in months.values()}
    gone = []
    for table in sorted(tables):
        base = hadoop.Path(f"{store}/{table}")
        for st in fs.listStatus(base) if fs.exists(base) else []:
            name = st.getPath().getName()
            if name.startswith(f"{LOAD}=") and (table, name.partition("=")[2]) not in needed:
                fs.delete(st.getPath(), True)
                gone.append(f"{table}/{name}")
    for n in numbers[:-keep]:
        fs.delete(hadoop.Path(folder, f"{n:08d}.json"), False)
    return gone
