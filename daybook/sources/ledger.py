"""Ledger of a source folder: what each file holds of each day, kept from one pass over the file.

A row per (file, day) with the number of rows, an order-independent digest of them, and the first and
last timestamp.  A refresh lists the files and reads only those that are new or changed; what files that
are gone held goes with them.  The ledger then answers three questions without reading a source row:

* **zone map**: which files a window needs, whether or not their folders tell the day
  (:meth:`SourceLedger.read_window`);
* **late rows**: which days have changed since a table took them.  A staging run records the days it
  took from the source (:meth:`SourceLedger.record`); a later comparison names the days whose count or
  digest is another one by now (:meth:`SourceLedger.changed_days`), such as rows that arrived for a
  day before the window and that a window run leaves out;
* **misplaced rows**: which rows lie in another day's folder (:meth:`SourceLedger.misplaced`), those too
  that a read pruned by folder never opens.

Scale: a file is read once in its life.  The ledger has a row per file and day, so it grows with the
number of files (a file of an unordered source holds all days, and no window can skip it); it is joined
and summed as a table.  To the driver come the paths of new files and of the window's files, as they
do for any scan that is given files, and days.

Rows without a timestamp count under a null day.  Equal rows count each in number and digest.  The digest
is a sum of 64-bit hashes of all columns, so a change goes unseen only if counts are equal and the sums collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.functions.dates import date_lit, partition_date
from daybook.sources.transactions import normalise_timestamp, window_rows
from daybook.sources.warehouse import Warehouse

FILES = "source_ledger"
FILE_COLUMNS = ["file", "length", "modified"]
DIGEST = "decimal(38,0)"


class SourceLedger:
    """The ledger of the Parquet files below ``root``, stored as tables of ``warehouse_root``."""

    def __init__(self, spark: SparkSession, root: str, warehouse_root: str, schema: T.StructType | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.tables = Warehouse(spark, f"{warehouse_root.rstrip('/')}/__ledger__")

    def _read(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.option("basePath", self.root)
        return (reader.schema(self.schema) if self.schema is not None else reader).parquet(*paths)

    def files(self) -> DataFrame:
        """``FILE_COLUMNS`` of the files there are now (a listing: no file is opened)."""
        listed = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                  .option("pathGlobFilter", "*.parquet").load(self.root))
        return listed.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))

    def entries(self) -> DataFrame:
        """The stored ledger: ``FILE_COLUMNS, day, rows, digest, first_ts, last_ts``; a file without rows has
        one entry of none."""
        return self.tables.read(FILES)

    def refresh(self) -> int:
        """Bring the ledger up to date; the number of files read."""
        present = self.files()
        known = self.entries() if self.tables.exists(FILES) else None
        fresh = present if known is None else present.join(known.select(*FILE_COLUMNS).distinct(), FILE_COLUMNS, "left_anti")
        paths = [r.file for r in fresh.collect()]  # new files
        parts = [] if known is None else [known.join(present, FILE_COLUMNS, "left_semi")]
        if paths:
            parts.append(self._counted(paths, fresh))
        if not parts:
            return 0
        ledger = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if paths or known.select("file").distinct().count() != ledger.select("file").distinct().count():
            self.tables.write_full(FILES, ledger)
        return len(paths)

    def _counted(self, paths: list[str], files: DataFrame) -> DataFrame:
        rows = self._read(paths)
        columns = [F.col(f"`{c}`") for c in rows.columns]
        # A scan names its files as URIs, a listing and a reader by their plain paths.
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        marked = rows.select(path.alias("file"), F.xxhash64(*columns).alias("hash"), S.ORDER_TS)
        marked = normalise_timestamp(marked).withColumn("day", F.to_date(S.ORDER_TS))
        counted = marked.groupBy("file", "day").agg(
            F.count("*").alias("rows"), F.sum(F.col("hash").cast(DIGEST)).cast(DIGEST).alias("digest"),
            F.min(S.ORDER_TS).alias("first_ts"), F.max(S.ORDER_TS).alias("last_ts"))
        zero = {"rows": F.coalesce("rows", F.lit(0).cast("long")), "digest": F.coalesce("digest", F.lit(0).cast(DIGEST))}
        return files.join(counted, "file", "left").withColumns(zero)

    # -- zone map ---------------------------------------------------------------------------------

    def window_files(self, from_date) -> list[str]:
        """The files that hold a row of a day on or after ``from_date``; all files without one."""
        entries = self.entries()
        if from_date is not None:
            entries = entries.filter(F.col("day") >= date_lit(from_date))
        return sorted(r.file for r in entries.select("file").distinct().collect())

    def read_window(self, from_date=None) -> DataFrame:
        """The source's rows of the window, read from the files that hold some.  As a ``Project``'s source it
        is what :func:`read_transactions` gives for any folder layout."""
        paths = self.window_files(from_date)
        rows = self._read(paths) if paths else self._read([self.root]).limit(0)
        return window_rows(normalise_timestamp(rows), from_date)

    # -- misplaced rows ---------------------------------------------------------------------------

    def misplaced(self, from_date) -> DataFrame:
        """``day, misplaced_rows, hidden_rows`` of the days with rows outside their own
        ``year=/month=/date=`` folder (rows of a folder without a date among them).  ``hidden_rows`` are in
        the window from ``from_date`` on, but in a dated folder before it: a read of a source declared
        day-aligned would lose them."""
        parts = {k: F.try_element_at(F.regexp_extract_all("file", F.lit(f"/{k}=([0-9]+)/")), F.lit(-1)).cast("int") for k in S.PARTITION_KEYS}
        placed = self.entries().filter("rows > 0 AND day IS NOT NULL").withColumns(parts).withColumn("folder", partition_date())
        hidden = (F.col("day") >= date_lit(from_date)) & (F.col("folder") < date_lit(from_date))
        return placed.filter(~F.col("day").eqNullSafe(F.col("folder"))).groupBy("day").agg(
            F.sum("rows").alias("misplaced_rows"), F.sum(F.when(hidden, F.col("rows")).otherwise(0)).alias("hidden_rows"))

    # -- late rows --------------------------------------------------------------------------------

    def days(self) -> DataFrame:
        """``day, rows, digest`` of the source; the null day is that of rows without a timestamp."""
        return self.entries().filter("rows > 0").groupBy("day").agg(F.sum("rows").alias("rows"), F.sum("digest").cast(DIGEST).alias("digest"))

    @staticmethod
    def _taken(name: str) -> str:
        return f"{name}_taken"

    def record(self, name: str, from_date=None) -> None:
        """Table ``name`` has taken the source's days on or after ``from_date``, or all, as the ledger has them."""
        days, table = self.days(), self._taken(name)
        if from_date is None or not self.tables.exists(table):
            self.tables.write_full(table, days if from_date is None else days.filter(F.col("day") >= date_lit(from_date)))
            return
        inside = F.coalesce(F.col("day") >= date_lit(from_date), F.lit(False))
        self.tables.write_full(table, self.tables.read(table).filter(~inside).unionByName(days.filter(inside)))

    def changed_days(self, name: str) -> DataFrame:
        """``day, stored_rows, source_rows, dropped_rows`` of the days that are not as table ``name`` took
        them: ``dropped_rows`` more rows are there now (fewer: negative; 0: others)."""
        taken = self.tables.read(self._taken(name)).select("day", F.col("rows").alias("stored_rows"), F.col("digest").alias("stored_digest"))
        both = self.days().alias("s").join(taken.alias("t"), F.col("s.day").eqNullSafe(F.col("t.day")), "full")
        zero = F.lit(0).cast("long")
        changed = ~(F.col("rows").eqNullSafe(F.col("stored_rows")) & F.col("digest").eqNullSafe(F.col("stored_digest")))
        return both.filter(changed).select(
            F.coalesce("s.day", "t.day").alias("day"), F.coalesce("stored_rows", zero).alias("stored_rows"),
            F.coalesce("rows", zero).alias("source_rows"),
            (F.coalesce("rows", zero) - F.coalesce("stored_rows", zero)).alias("dropped_rows"))
