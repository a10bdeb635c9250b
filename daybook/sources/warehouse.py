"""Parquet tables in a folder: existence, reads, and the three write disciplines.

A table is a folder with one data folder per *version* and a small pointer file that names the
current one.  A rebuild writes a new version beside the old and then replaces the pointer by one
atomic rename, so readers and stopped runs see the old table or the new one, never none; what a
stopped run left behind is removed by the next rebuild.

* ``write_full`` (materialisation ``table``): a new version.  A rebuild may read the table it
  replaces.
* ``replace_days`` (``delete+insert`` on ``order_date``): only the days present in the frame are
  replaced.  The frame is checkpointed first (to the shared checkpoint folder) because it is
  usually derived from the same table (the seed row).  Metric tables hold one row per calendar day,
  so they are kept unpartitioned (one small file instead of a folder per day) and rewritten whole.
* ``delete_insert`` (``delete+insert`` on a non-unique key such as ``order_id``): replaces all
  rows of every touched key, rewriting only the partitions involved: the batch's days plus the days
  where target rows with those keys live (an order can move between days).  Rows without a day are a
  partition like any other.

A day-partitioned table has a *day list* as well: the folder that holds each day, and the table's
schema.  Rows of a day lie in ``order_date=<day>/day_revision=<revision>``, one revision or, where rows were
only added (``append_days``), several; a write appends folders of a revision of its own, which no reader looks at, then writes a new list and names it in the pointer by the
same atomic rename.  So the days of one write change together, emptied days among them: a reader sees
all of them as they were or as they are, also one that began before.  Replaced folders stay until the
write after the next begins; what a stopped write left is removed by the next one (a table has one
writer at a time).  The list's schema is that of every column any batch brought: a read takes it from
there and opens no file footers, and a batch whose column has another type is refused before anything is
written.  The list has a line a day, whatever the number of rows.

The days that hold the batch's keys are found through the table's *key index* where it has one (a
table property: once built it is maintained by every upsert, whatever the batch), else by joining
the stored key column.  Either way the choice of join is left to adaptive execution, which
broadcasts by measured size and splits hot keys.

The order-line tables are partitioned by ``order_date``.  After a shuffle, ``rebalance`` on the
partition column lets AQE split a hot day into several tasks and coalesce small days before the
write; a full build from a day-laid-out scan needs no shuffle at all.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.functions.dates import parse_date
from daybook.operators.upsert import merged_columns, replace_days
from daybook.session import checkpoint_root
from daybook.sources.fs import (
    delete_path,
    list_subdirs,
    path_exists,
    read_small,
    rename_path,
    replace_small,
)

NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
POINTER = "_current"  # "<version>", of a day-partitioned table "<version> <revision>"
DATA = "data-"
DAYS = "_days-"  # _days-<revision> in the data folder: a day list
WRITING = "_writing"  # _writing/<revision> in the data folder: the days that a write is about to replace
REVISION = "day_revision"
KEYS = "keys-"  # keys-<version>-b<buckets>: an index belongs to one version of its table
INDEX_MONTH = "index_month"
KEY_HASH = "key_hash"


def folder_value(value) -> str:
    return NULL_DAY if value is None else value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)


def partition_dir(table_path: str, column: str, value) -> str:
    return f"{table_path.rstrip('/')}/{column}={folder_value(value)}"


def folder_day(value: str) -> dt.date | None:
    """Day of an ``order_date=`` folder name's value; None for rows without a day."""
    return None if value == NULL_DAY else parse_date(value)


def in_days(column: Column, days) -> Column:
    """``column`` is one of ``days``; None among them stands for NULL.  Never NULL itself."""
    known = sorted(d for d in days if d is not None)
    hit = F.coalesce(column.isin(known), F.lit(False)) if known else F.lit(False)
    return hit | column.isNull() if None in days else hit


def month_of(day: dt.date | None) -> dt.date | None:
    return None if day is None else day.replace(day=1)


@dataclass
class WriteResult:
    table: str
    partitions_written: int
    partitions_dropped: int = 0
    days: list = field(default_factory=list)  # days whose rows changed (upserts)


@dataclass(frozen=True)
class DayList:
    """What a day-partitioned table consists of."""

    schema: T.StructType  # every column that a batch brought
    revisions: dict  # day, as a folder name has it -> the revisions that hold its rows
    replaced: list  # (day, revision) of the list before that this one has no more

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "revisions": self.revisions, "replaced": self.replaced})

    @classmethod
    def parse(cls, text: str) -> DayList:
        d = json.loads(text)
        return cls(T.StructType.fromJson(d["schema"]), d["revisions"], d["replaced"])

    def with_columns_of(self, name: str, batch: T.StructType) -> T.StructType:
        """The schema with the batch's new columns after it; a column of another type is refused."""
        for f in batch:
            if f.name in self.schema.names and f.dataType.simpleString() != (old := self.schema[f.name].dataType.simpleString()):
                raise TypeError(f"{name}: column {f.name} is {old} in the table, {f.dataType.simpleString()} in the batch")
        return T.StructType(self.schema.fields + [f for f in batch if f.name not in self.schema.names])


@dataclass(frozen=True)
class Stored:
    """One state of a table, from one look at its pointer."""

    version: str
    root: str  # data folder
    revision: str | None  # None: not partitioned
    days: DayList | None


class Warehouse:
    """A folder of tables, one sub-folder each."""

    def __init__(self, spark: SparkSession, root: str, partition_col: str = S.ORDER_DATE,
                 key_index: bool = False, key_buckets: int | None = None):
        """``key_index``: give day-partitioned tables a key index at their first upsert.  A table
        that has one keeps it, whatever this says."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_col = partition_col
        self.key_index = key_index
        self.key_buckets = key_buckets

    # -- versions ---------------------------------------------------------------------------------

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def version(self, name: str) -> str | None:
        """The current version, or None if the table does not exist."""
        pointer = read_small(self.spark, f"{self.folder(name)}/{POINTER}")
        return None if pointer is None else pointer.split()[0]

    def stored(self, name: str) -> Stored:
        pointer = read_small(self.spark, f"{self.folder(name)}/{POINTER}")
        if pointer is None:
            raise FileNotFoundError(f"no table {name} in {self.root}")
        version, _, revision = pointer.partition(" ")
        root = f"{self.folder(name)}/{DATA}{version}"
        if not revision:
            return Stored(version, root, None, None)
        return Stored(version, root, revision, DayList.parse(read_small(self.spark, f"{root}/{DAYS}{revision}")))

    def path(self, name: str) -> str:
        """Data folder of the current version."""
        return self.stored(name).root

    def days(self, name: str) -> list:
        """The days of a day-partitioned table; None for rows without one."""
        return [folder_day(v) for v in sorted(self.stored(name).days.revisions)]

    def exists(self, name: str) -> bool:
        """Table existence (``information_schema`` lookup in the reference)."""
        return self.version(name) is not None

    def _switch(self, name: str, version: str, revision: str | None = None) -> None:
        self._point(name, version, revision)
        self._sweep(name, version)

    def _point(self, name: str, version: str, revision: str | None) -> None:
        replace_small(self.spark, f"{self.folder(name)}/{POINTER}", version if revision is None else f"{version} {revision}")

    def _sweep(self, name: str, current: str) -> None:
        """Remove what belongs to other versions: the replaced one, and what stopped runs left."""
        for entry, full in list_subdirs(self.spark, self.folder(name)):
            if not entry.startswith((f"{DATA}{current}", f"{KEYS}{current}-b")):
                if entry.startswith(KEYS):
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._index_table(full)}")
                delete_path(self.spark, full)

    # -- reads ------------------------------------------------------------------------------------

    def day_folders(self, stored: Stored, keep) -> list[tuple]:
        """(day, folder) of the days that satisfy ``keep``, from the day list; the day is None for rows
        without one."""
        found = ((folder_day(v), f"{stored.root}/{self.partition_col}={v}/{REVISION}={r}")
                 for v, held in sorted(stored.days.revisions.items()) for r in held)
        return [(d, f) for d, f in found if keep(d)]

    def read_folders(self, stored: Stored, folders: list[tuple]) -> DataFrame:
        """Read the given day folders only (the file index lists nothing else), with the table's schema;
        without any, a typed empty frame."""
        if not folders:
            return self.spark.createDataFrame([], stored.days.schema)
        return (self.spark.read.schema(stored.days.schema).option("basePath", stored.root)
                .parquet(*[f for _, f in folders]).select(*[F.col(f"`{c}`") for c in stored.days.schema.names]))

    def read(self, name: str, merge_schema: bool = False, from_date=None, days=None) -> DataFrame:
        """Scan a stored table.  A day-partitioned one has its folders and its schema from the day list;
        with ``from_date`` or ``days`` only those day folders are handed to the file index, so files of
        other days are never listed.  ``merge_schema`` reads all footers of a table without a day list
        (a distributed job); tables written by this class have one schema and don't need it."""
        stored = self.stored(name)
        keep = lambda d: True
        if from_date is not None:
            first = parse_date(from_date)
            keep = lambda d: d is not None and d >= first
        elif days is not None:
            keep = set(days).__contains__
        if stored.days is not None:
            df = self.read_folders(stored, self.day_folders(stored, keep))
        else:
            df = self.spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(stored.root)
        if from_date is not None:
            df = df.filter(F.col(self.partition_col) >= F.lit(first))
        elif days is not None:
            df = df.filter(in_days(F.col(self.partition_col), set(days)))
        known = [c for c in S.STAGING_COLUMNS + S.RUNNING_COLUMNS if c in df.columns]
        return df.select(*dict.fromkeys(known + df.columns))

    def register_views(self, names=None) -> list[str]:
        """Expose stored tables to Spark SQL as temporary views under their model names."""
        done = []
        for name in names or sorted(self.table_names()):
            if self.exists(name):
                self.read(name, merge_schema=name.startswith("stg_")).createOrReplaceTempView(name)
                done.append(name)
        return done

    def table_names(self) -> list[str]:
        return [name for name, _ in list_subdirs(self.spark, self.root) if "__" not in name and self.exists(name)]

    def read_or_empty(self, name: str, schema: T.StructType, merge_schema: bool = False) -> DataFrame:
        """The stored table, or a typed empty frame if it does not exist.  Other errors propagate."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.read(name, merge_schema)

    # -- key index of a day-partitioned table ----------------------------------------------------
    #
    # The upsert must find the days holding rows of the batch's keys anywhere in the history.
    # Joining the whole history's key column against the batch would shuffle the history on every
    # run.  The key index holds the distinct (key hash, day) pairs of the stored rows in a catalog
    # table bucketed by the hash, so that join reads each bucket in place and shuffles only the
    # batch's keys.  It is partitioned by month: a few files per bucket over the whole history, and
    # an upsert rewrites the index of one or two months.  A hot key is one pair per day, so the
    # bucketed write has no skew.  The index only has to be a superset of the stored pairs: a stale
    # pair or a hash collision causes one extra day to be rewritten unchanged, never a wrong result.

    def _index_dir(self, name: str) -> tuple[str, int] | None:
        """(folder, buckets) of a finished index of the current version."""
        prefix = f"{KEYS}{self.version(name)}-b"
        for entry, full in list_subdirs(self.spark, self.folder(name), prefix):
            if entry[len(prefix):].isdigit() and path_exists(self.spark, f"{full}/_SUCCESS"):
                return full, int(entry[len(prefix):])
        return None

    def has_key_index(self, name: str) -> bool:
        return self._index_dir(name) is not None

    @staticmethod
    def _index_table(path: str) -> str:
        return "daybook_keyindex_" + hashlib.sha1(path.encode()).hexdigest()[:16]

    def _index_pairs(self, rows: DataFrame, key: str, buckets: int) -> DataFrame:
        """Distinct (key hash, day, month) pairs, shuffled so that each (month, bucket) is one task."""
        pc = self.partition_col
        pairs = rows.select(F.xxhash64(key).alias(KEY_HASH), pc).distinct()
        pairs = pairs.withColumn(INDEX_MONTH, F.trunc(F.col(pc), "month").cast("date"))
        return (pairs.repartition(F.col(INDEX_MONTH), F.pmod(F.hash(F.col(KEY_HASH)), F.lit(buckets)))
                .select(KEY_HASH, pc, INDEX_MONTH))

    def ensure_key_index(self, name: str, key: str) -> tuple[str, int]:
        """Register (or build, once, from the stored rows) the key index of ``name``.  It is built
        in a folder of its own and renamed when complete, so a stopped build is never mistaken for
        an index."""
        found = self._index_dir(name)
        if found is None:
            n = self.key_buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            final = f"{self.folder(name)}/{KEYS}{self.version(name)}-b{n}"
            building = f"{final}__building__{uuid.uuid4().hex[:12]}"
            tbl = self._index_table(building)
            (self._index_pairs(self.read(name), key, n).write.partitionBy(INDEX_MONTH).bucketBy(n, KEY_HASH)
             .mode("errorifexists").option("path", building).saveAsTable(tbl))
            self.spark.sql(f"DROP TABLE {tbl}")  # external: the files stay
            delete_path(self.spark, final)  # a half-built folder of this name
            rename_path(self.spark, building, final)
            found = final, n
        path, n = found
        tbl = self._index_table(path)
        if not self.spark.catalog.tableExists(tbl):
            self.spark.sql(
                f"CREATE TABLE {tbl} (`{KEY_HASH}` BIGINT, `{self.partition_col}` DATE, `{INDEX_MONTH}` DATE) "
                f"USING parquet PARTITIONED BY (`{INDEX_MONTH}`) CLUSTERED BY (`{KEY_HASH}`) INTO {n} BUCKETS "
                f"LOCATION '{path}'")
            self.spark.sql(f"ALTER TABLE {tbl} RECOVER PARTITIONS")
        return tbl, n

    def _refresh_index_months(self, name: str, key: str, tbl: str, n: int, days: list) -> None:
        """Rebuild the index of the days' months exactly from the stored rows (reads the table,
        never the index, which cannot be overwritten while read)."""
        months = {month_of(d) for d in days}
        stored = self.stored(name)
        folders = self.day_folders(stored, lambda d: month_of(d) in months)
        if folders:
            (self._index_pairs(self.read_folders(stored, folders), key, n).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").insertInto(tbl))
        present = {month_of(d) for d, _ in folders}
        path, _ = self._index_dir(name)
        for m in months - present:  # no stored day left in that month: its index must go too
            value = "NULL" if m is None else f"DATE'{m.isoformat()}'"
            self.spark.sql(f"ALTER TABLE {tbl} DROP IF EXISTS PARTITION (`{INDEX_MONTH}` = {value})")
            delete_path(self.spark, partition_dir(path, INDEX_MONTH, m))
        self.spark.catalog.refreshTable(tbl)

    # -- writes -----------------------------------------------------------------------------------

    def _write_days(self, root: str, rows: DataFrame, revision: str, rebalance: bool, sort_by: tuple = ()) -> None:
        """Append the rows as day folders of a revision of their own."""
        if rebalance:  # AQE sizes the output files
            rows = rows.hint("rebalance", self.partition_col)
        rows = rows.withColumn(REVISION, F.lit(revision))
        if sort_by:
            rows = rows.sortWithinPartitions(self.partition_col, REVISION, *sort_by)
        (rows.write.partitionBy(self.partition_col, REVISION)
         .mode("append").parquet(root))

    def write_full(self, name: str, df: DataFrame, partition_col: str | None = None,
                   rebalance: bool = True, sort_by: tuple = ()) -> WriteResult:
        """Write a new version, then switch to it.  ``rebalance=False`` skips the shuffle when the
        input is already laid out by day (a scan of a day-partitioned source): each task then
        writes the few days it holds."""
        self._known_column(partition_col)
        version = uuid.uuid4().hex[:12]
        data = f"{self.folder(name)}/{DATA}{version}"
        if partition_col is None:
            df.hint("rebalance").write.mode("errorifexists").parquet(data)
            self._switch(name, version)
            return WriteResult(name, -1)
        revision = self._new_revision()
        self._write_days(data, df, revision, rebalance, sort_by)
        prefix = f"{partition_col}="
        held = {entry[len(prefix):]: [revision] for entry, _ in list_subdirs(self.spark, data, prefix)}
        replace_small(self.spark, f"{data}/{DAYS}{revision}", DayList(df.schema, held, []).text())
        self._switch(name, version, revision)
        return WriteResult(name, len(held))

    def _known_column(self, partition_col: str | None) -> None:
        if partition_col not in (None, self.partition_col):
            raise ValueError(f"tables of this warehouse are partitioned by {self.partition_col}, not {partition_col}")

    @staticmethod
    def _new_revision() -> str:
        return f"r{uuid.uuid4().hex[:12]}"

    def _clear(self, stored: Stored) -> None:
        """Remove what the current day list doesn't name: what the last write replaced, and what stopped
        writes left.  Harmless if repeated."""
        def day_folder(value: str, revision: str) -> str:
            day = f"{stored.root}/{self.partition_col}={value}"
            return f"{day}/{REVISION}={revision}" if value in stored.days.revisions else day
        for value, revision in stored.days.replaced:
            delete_path(self.spark, day_folder(value, revision))
        current = {stored.revision}.union(*stored.days.revisions.values())
        for revision, mark in list_subdirs(self.spark, f"{stored.root}/{WRITING}"):
            if revision not in current:
                for value in json.loads(read_small(self.spark, mark)):
                    delete_path(self.spark, day_folder(value, revision))
                delete_path(self.spark, f"{stored.root}/{DAYS}{revision}")
            delete_path(self.spark, mark)

    def _replace(self, name: str, stored: Stored, rows: DataFrame, touched: list, schema: T.StructType,
                 added: frozenset = frozenset(), sort_by: tuple = ()) -> tuple[int, int]:
        """The touched days become ``rows``, all at once; those ``added`` to keep what they hold.  (days
        written, days emptied)"""
        self._clear(stored)
        revision, before = self._new_revision(), stored.days.revisions
        values = [folder_value(d) for d in touched]
        kept = {folder_value(d) for d in added}
        mark = f"{stored.root}/{WRITING}/{revision}"
        replace_small(self.spark, mark, json.dumps(values))
        self._write_days(stored.root, rows, revision, rebalance=True, sort_by=sort_by)
        written = {v: (before.get(v, []) if v in kept else []) + [revision] for v in values
                   if path_exists(self.spark, f"{stored.root}/{self.partition_col}={v}/{REVISION}={revision}")}
        replaced = {v: before[v] for v in values if v in before and v not in kept}
        after = DayList(schema, {**{v: r for v, r in before.items() if v not in replaced}, **written},
                        [(v, r) for v, held in replaced.items() for r in held])
        replace_small(self.spark, f"{stored.root}/{DAYS}{revision}", after.text())
        self._point(name, stored.version, revision)
        delete_path(self.spark, mark)
        return len(written), len(replaced.keys() - written.keys())

    def append_days(self, name: str, rows: DataFrame, days: list, sort_by: tuple = (), most: int = 16) -> WriteResult:
        """Add rows to ``days`` (every day of ``rows``) without rewriting what they hold; a day that has
        ``most`` revisions is made one again.  Files are sorted by ``sort_by`` within a day."""
        if not self.exists(name):
            return self.write_full(name, rows, self.partition_col, sort_by=sort_by)
        stored = self.stored(name)
        schema = stored.days.with_columns_of(name, rows.schema)
        full = {d for d in days if len(stored.days.revisions.get(folder_value(d), ())) >= most}
        if full:
            rows = self.read_folders(stored, self.day_folders(stored, full.__contains__)).unionByName(rows, allowMissingColumns=True)
        written, _ = self._replace(name, stored, rows, days, schema, frozenset(days) - full, sort_by)
        return WriteResult(name, written, 0, days)

    def replace_days(self, name: str, days: DataFrame, partition_col: str | None = None) -> WriteResult:
        """delete+insert by ``order_date``: the days present in ``days`` are replaced, all others kept.

        ``days`` is checkpointed first: it is small (one row per day) and usually derived from this
        very table (the seed row), so the write then reads stable files and a lost executor
        recomputes from the checkpoint.  An unpartitioned table (the metric tables: one row per
        calendar day) becomes a new version; a day-partitioned table gets a new day list."""
        self._known_column(partition_col)
        checkpoint_root(self.spark)
        stable = days.checkpoint(eager=True)
        n_days = stable.count()  # one row per day
        if not self.exists(name):
            self.write_full(name, stable, partition_col)
            return WriteResult(name, n_days)
        if n_days == 0:
            return WriteResult(name, 0)
        if partition_col is None:
            merged = replace_days(self.read(name), stable)  # rewritten whole: one schema
            self.write_full(name, merged)
            return WriteResult(name, n_days)
        stored = self.stored(name)
        schema = stored.days.with_columns_of(name, stable.schema)
        days = [r[0] for r in stable.select(partition_col).distinct().collect()]  # one row per day
        self._replace(name, stored, stable, days, schema)
        return WriteResult(name, n_days)

    def delete_insert(self, name: str, batch: DataFrame, key: str, partition_col: str = S.ORDER_DATE) -> WriteResult:
        """delete+insert by a non-unique key on a table partitioned by ``partition_col``.

        1. The batch is written once to a folder of the warehouse and read from there.
        2. Days *outside* the batch's that hold rows of its keys (orders that moved): through the
           key index, shuffling only the batch's keys, or by a join on a 64-bit hash of the stored
           keys.  Both give a superset of the true days; a collision rewrites a day unchanged.
        3. Rewrite the touched days: target rows whose (real) key is not in the batch, plus the
           batch; days left empty by the delete leave the day list.  Rows without a key never match
           and bypass the join.
        """
        self._known_column(partition_col)
        if not self.exists(name):
            return self.write_full(name, batch, partition_col)
        self.stored(name).days.with_columns_of(name, batch.schema)
        held = f"{self.root}/__batch__{uuid.uuid4().hex[:12]}"
        try:
            batch.write.parquet(f"{held}/rows")
            stable = self.spark.read.schema(batch.schema).parquet(f"{held}/rows")
            # Distinct keys as a table of their own: below the rewrite's join then stand plain
            # shuffles, which adaptive execution can split at a hot key.
            stable.select(key).filter(F.col(key).isNotNull()).distinct().write.parquet(f"{held}/keys")
            keys = self.spark.read.schema(stable.select(key).schema).parquet(f"{held}/keys")
            return self._upsert(name, stable, keys, key, partition_col)
        finally:
            delete_path(self.spark, held)

    def _upsert(self, name: str, batch: DataFrame, keys: DataFrame, key: str, pc: str) -> WriteResult:
        batch_days = {r[0] for r in batch.select(pc).distinct().collect()}  # one row per day
        indexed = self.key_index or self.has_key_index(name)
        hashes = keys.select(F.xxhash64(key).alias(KEY_HASH))
        if indexed:
            tbl, n = self.ensure_key_index(name, key)
            history = self.spark.table(tbl)
            hashes = hashes.repartition(n, KEY_HASH).distinct()  # the index's bucketing
        else:
            history = self.read(name).select(F.xxhash64(key).alias(KEY_HASH), pc)
        elsewhere = history.filter(~in_days(F.col(pc), batch_days))
        hit_days = {r[0] for r in elsewhere.join(hashes, KEY_HASH, "left_semi").select(pc).distinct().collect()}
        touched = sorted(batch_days | hit_days, key=lambda d: (d is None, d or dt.date.min))
        if not touched:
            return WriteResult(name, 0)
        if indexed:
            # Record the batch's pairs first: should the run stop after this, the index is a
            # superset of the stored pairs, which is safe.
            self._index_pairs(batch, key, n).write.mode("append").insertInto(tbl)
        # Only the touched days' folders are listed and read.
        stored = self.stored(name)
        schema = stored.days.with_columns_of(name, batch.schema)
        target = self.read_folders(stored, self.day_folders(stored, set(touched).__contains__))
        kept = (target.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")
                .unionByName(target.filter(F.col(key).isNull())))
        out = kept.unionByName(batch, allowMissingColumns=True).select(*merged_columns(target, batch))
        written, emptied = self._replace(name, stored, out, touched, schema)
        if indexed:
            self._refresh_index_months(name, key, tbl, n, touched)
        return WriteResult(name, written, emptied, touched)
