"""Shared pieces of the corpus operators: table reads, written intermediates, input normalising."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_path, ship_package
from daybook.sources.fs import delete_path

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Rows, and bytes, in an Arrow batch: whole texts travel, so far fewer than for plain numbers.
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings of the corpus operators; ships the package to the Python workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Every intermediate is a written table, so a finished job's shuffle files are never read again.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` for the jobs run inside: many more for rows of a few numbers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written intermediates of one operator call, removed when it is done.

    ``with Scratch(spark) as scratch:`` everything that :func:`written` writes inside is deleted at
    the end, but for what ``scratch.keep`` wrote: the results, which read nothing else."""

    _open: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        Scratch._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch._open.remove(self)
        for path in self.paths:
            delete_path(self.spark, path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        at = Scratch._open.index(self)
        return _write(df, name, Scratch._open[at - 1] if at else None)


def _write(df: DataFrame, name: str, scope: Scratch | None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if scope is not None:
        scope.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts the lineage, so a
    lost executor costs the re-read of files, and values that depend on the task layout (running
    ranks, partition numbers) are fixed by the files."""
    return _write(df, name, Scratch._open[-1] if Scratch._open else None)


def text_or_empty(c: str | Column = "text") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: an array of one element binds it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Sieve:
    """A bitmap of fixed size over hashed keys, for broadcast: it lets every member through and
    stops most others, so that large rows of non-members need no shuffle.  Its size never depends on
    the number of members; with very many it merely stops less, and results stay the same because an
    exact join follows."""

    BITS = 1 << 23

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def slots(keys: list[np.ndarray]) -> np.ndarray:
        h = np.zeros(len(keys[0]), np.uint64)
        for k in keys:
            h = (h ^ k.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - Sieve.BITS.bit_length() + 1)

    @staticmethod
    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [c.fill_null(-1).to_numpy(zero_copy_only=False) for c in batch.columns]

    @classmethod
    def build(cls, members: DataFrame):
        """Broadcast of the sieve over the (long) columns of ``members``."""
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = np.zeros(cls.BITS // 64, np.uint64)
            for b in batches:
                at = cls.slots(cls.columns(b))
                np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
            full = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64)), pa.array(words[full].view(np.int64))], ["word", "bits"])
        got = members.mapInArrow(part, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(cls.BITS // 64, np.uint64)
        words[got.column("word").to_numpy()] = got.column("bits").to_numpy().astype(np.int64).view(np.uint64)
        return members.sparkSession.sparkContext.broadcast(cls(words))

    def __call__(self, *keys: np.ndarray) -> np.ndarray:
        at = self.slots(list(keys))
        return ((self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def packed(df: DataFrame, *keys: str) -> DataFrame:
    """``row``, a struct of all columns, beside copies of the ``keys``: whatever an operator adds can
    then not clash with a column of the table.  ``select("row.*")`` undoes it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *keys)


def _is_file_scan(df: DataFrame) -> bool:
    """Whether the rows of ``df`` are rows of files, at most filtered and with fewer columns."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" and "_metadata" not in df.columns


def numbered(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``file``, ``place``: two numbers that tell any two
    rows apart, equal ones too, and are the same in every scan.  They are a 64-bit hash of the row's file
    and its place there; rows that do not come from Parquet files as they are get written first."""
    if _is_file_scan(docs):
        try:
            return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                               F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
        except AnalysisException:  # files of another format have no row numbers
            pass
    rows = written(packed(docs), "rows")
    return rows.select("row", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))


def split_by(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be in ``keys``, rows whose ``key`` is certainly not)."""
    sieve = Sieve.build(keys.select(F.col(key).cast("long")))

    @F.pandas_udf("boolean")
    def may_hold(s: pd.Series) -> pd.Series:
        return pd.Series(sieve.value(s.fillna(-1).to_numpy(np.int64)))

    marked = df.withColumn("_may", may_hold(F.col(key).cast("long")))
    return marked.filter("_may").drop("_may"), marked.filter(~F.col("_may")).drop("_may")
