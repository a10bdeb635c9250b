"""Exact nearest neighbours of a stated query set by a blocked, quantised matrix join.

Both sides become tables of *tiles*, matrices of at most ``TILE`` vectors of one dimension.  Query tiles
are numbered and ``QUERY_BLOCK`` queries make a block; row tiles fall by hash into row groups.  A cell of
the block matrix is a (query block, row group) pair: the query tiles are sent to every row group, the
row tiles to every query block, and Spark shuffles and sorts them so that a task meets the queries of a
cell first and then streams its row tiles past them.

A product tile multiplies int8 codes: ``x = scale * code + rest`` with the length of ``rest`` known, so
the distance has a lower and an upper bound whose width is the quantisation error (Cauchy-Schwarz on the
rests, plus a margin for rounding).  The k-th smallest upper bound of a query, or the worst of its k best
so far, is a ceiling; only pairs whose lower bound is not above it survive.  They are recomputed from the
original components in double precision and go to the query's heap.  The heaps of all cells of a query
are merged by rank.

Scale: work is (queries x rows), which an exact search of a stated query set against all rows needs.  A
task holds one query block and one row tile whatever the corpus; nothing is broadcast, and no vector
passes the driver.  Rows are shuffled once per query block (their number is queries / ``QUERY_BLOCK``),
queries once per row group, and a cell sends on at most ``k`` rows a query.  Products of int8 codes are
summed as floats of 24 bits, exact for the slices of at most ``SLICE`` components that are multiplied at
a time.

Bounds and distances are formed relative to the larger vector's power of two, so finite vectors of any
length take part: nothing overflows but a distance that no double can hold, which is infinite.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no
part on either side; only vectors of equal dimension are compared; fewer than ``k`` candidates: all
of them; ties go to the smaller ``vec_id``; rows without an id are left out; rows that repeat an id
are candidates each, but never of their own id, and as a query the smallest vector that takes part stands for them; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import Scratch, batches_of, written

QUERY_BLOCK = 8192   # queries held by a task
ROW_GROUP = 524_288  # about as many rows stream past them
TILE = 1024
TILE_BYTES = 1 << 20
SLICE = 1024
MARGIN = 1e-5
TILES = "part long, seq long, width int, ids binary, data binary"


class Codes:
    """int8 codes of the rows of a matrix.  ``x = 2^power * unit`` with a peak of ``unit`` below 1; codes,
    their scales, lengths of what they leave over and squared lengths are those of ``unit``."""

    def __init__(self, x: np.ndarray):
        self.exact = x
        self.power = np.frexp(np.abs(x).max(axis=1))[1]
        unit = np.ldexp(x, -self.power[:, None])
        self.scale = np.abs(unit).max(axis=1) / 127.0
        self.code = np.rint(unit / self.scale[:, None]).astype(np.int8)
        coded = self.code * self.scale[:, None]
        self.rest = np.sqrt(((unit - coded) ** 2).sum(axis=1))
        self.coded = np.sqrt((coded ** 2).sum(axis=1))
        self.square = (unit ** 2).sum(axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """int8 x int8 products, exact."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], SLICE):
        out += a[:, i:i + SLICE].astype(np.float32) @ b[:, i:i + SLICE].astype(np.float32).T
    return out


def distance_bounds(q: Codes, x: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of all pairs."""
    top = np.maximum(q.power[:, None], x.power)
    fq, fx = np.ldexp(1.0, q.power[:, None] - top), np.ldexp(1.0, x.power - top)
    both = fq * fx
    squares = fq ** 2 * q.square[:, None] + fx ** 2 * x.square
    mid = squares - 2 * both * products(q.code, x.code) * q.scale[:, None] * x.scale
    err = 2 * both * (q.rest[:, None] * x.coded + q.coded[:, None] * x.rest + q.rest[:, None] * x.rest) + MARGIN * squares
    with np.errstate(over="ignore"):
        return np.ldexp(np.sqrt(np.maximum(mid - err, 0.0)), top), np.ldexp(np.sqrt(np.maximum(mid + err, 0.0)), top)


def distances(q: Codes, at_q: np.ndarray, x: Codes, at_x: np.ndarray) -> np.ndarray:
    """Distances of the pairs in double precision, from the original components."""
    top = np.maximum(q.power[at_q], x.power[at_x])
    total = np.zeros(len(at_q))
    for a, b in zip(q.exact.T, x.exact.T):  # component by component: the sum's order is fixed
        total += (np.ldexp(a[at_q], -top) - np.ldexp(b[at_x], -top)) ** 2
    with np.errstate(over="ignore"):
        return np.ldexp(np.sqrt(total), top)


def _matrices(ids: np.ndarray, column: pa.Array, dtype: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) per dimension of the vectors of a list column that take part."""
    flat = column.flatten()
    if column.null_count == 0 and flat.null_count == 0:
        values = flat.to_numpy(zero_copy_only=False).astype(dtype)
        ends = column.offsets.to_numpy() - column.offsets[0].as_py()
        widths = np.diff(ends)
        groups = ((w, np.flatnonzero(widths == w)) for w in np.unique(widths[widths > 0]))
        found = ((at, values[ends[:-1][at][:, None] + np.arange(w)]) for w, at in groups)
    else:
        vectors = column.to_pylist()
        by_width: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            if v and None not in v:
                by_width.setdefault(len(v), []).append(i)
        found = ((np.array(at), np.array([vectors[i] for i in at], dtype)) for at in by_width.values())
    for at, x in found:
        good = np.isfinite(x).all(axis=1) & x.any(axis=1)
        if good.any():
            yield ids[at[good]], x[good]


def _tiles(batches: Iterator[pa.RecordBatch], dtype: str, tile: int) -> Iterator[pa.RecordBatch]:
    """The task's vectors as tiles.  Of each dimension less than a tile is held; all are let go when many
    dimensions together hold more than a few tiles."""
    part, seq = TaskContext.get().partitionId(), 0
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def emit(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        nonlocal seq
        seq += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([seq - 1], pa.int64()), pa.array([x.shape[1]], pa.int32()),
             pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())],
            ["part", "seq", "width", "ids", "data"])

    for batch in batches:
        for ids, x in _matrices(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1), dtype):
            width = x.shape[1]
            held.setdefault(width, []).append((ids, x))
            size = max(1, min(tile, TILE_BYTES // (8 * width)))
            if sum(len(i) for i, _ in held[width]) >= size:
                ids, x = (np.concatenate(c) for c in zip(*held.pop(width)))
                whole = len(ids) // size * size
                for i in range(0, whole, size):
                    yield emit(ids[i:i + size], x[i:i + size])
                if whole < len(ids):
                    held[width] = [(ids[whole:], x[whole:])]
        if sum(x.nbytes for parts in held.values() for _, x in parts) > 8 * TILE_BYTES:
            for parts in held.values():
                yield emit(*(np.concatenate(c) for c in zip(*parts)))
            held.clear()
    for parts in held.values():
        yield emit(*(np.concatenate(c) for c in zip(*parts)))


class Best:
    """A heap of the k nearest found so far for every query of a tile, the worst on top."""

    def __init__(self, ids: np.ndarray, q: Codes, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.worst = np.full(len(ids), np.inf)

    def tile(self, ids: np.ndarray, x: Codes) -> None:
        low, high = distance_bounds(self.q, x)
        own = self.ids[:, None] == ids
        high[own] = np.inf
        ceiling = self.worst
        if high.shape[1] >= self.k:
            ceiling = np.minimum(ceiling, np.partition(high, self.k - 1, axis=1)[:, self.k - 1])
        with np.errstate(over="ignore"):
            ceiling = np.nextafter(ceiling * (1 + MARGIN), np.inf)
        at_q, at_x = np.nonzero((low <= ceiling[:, None]) & ~own)
        for i, near, who in zip(at_q.tolist(), distances(self.q, at_q, x, at_x).tolist(), ids[at_x].tolist()):
            heap = self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, (-near, -who))
            else:
                heapq.heappushpop(heap, (-near, -who))
            if len(heap) == self.k:
                self.worst[i] = -heap[0][0]

    def found(self) -> pa.RecordBatch:
        sizes = [len(h) for h in self.heaps]
        near = [(-d, -w) for h in self.heaps for d, w in h]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, sizes), pa.int64()), pa.array([w for _, w in near], pa.int64()),
             pa.array([d for d, _ in near], pa.float64())], ["query_id", "vec_id", "score"])


def _cells(batches: Iterator[pa.RecordBatch], dtype: str, k: int) -> Iterator[pa.RecordBatch]:
    """Query tiles, then row tiles, of one cell after the other."""
    cell, held = None, []
    for batch in batches:
        head = zip(*(batch.column(c).to_pylist() for c in ("qb", "rg", "is_row", "width")))
        for (qb, rg, is_row, width), raw_ids, raw in zip(head, batch.column("ids"), batch.column("data")):
            if (qb, rg) != cell:
                yield from (b.found() for b in held)
                cell, held = (qb, rg), []
            mine = [b for b in held if b.q.exact.shape[1] == width]
            if is_row and not mine:
                continue
            ids = np.frombuffer(raw_ids.as_buffer(), np.int64)
            codes = Codes(np.frombuffer(raw.as_buffer(), dtype).reshape(len(ids), width).astype(np.float64))
            if is_row:
                for b in mine:
                    b.tile(ids, codes)
            else:
                held.append(Best(ids, codes, k))
    yield from (b.found() for b in held)


def _numbered(tiles: DataFrame, per_block: int) -> DataFrame:
    """The query tiles with their block, ``per_block`` tiles each.  The window runs over one row per task
    that made tiles."""
    sizes = tiles.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return tiles.join(before, "part").withColumn("qb", F.floor((F.col("before") + F.col("seq")) / per_block))


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of every row with ``is_query``."""
    spark = vectors.sparkSession
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    dtype = "f4" if single else "f8"  # tiles keep the components as they are
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vec_col).cast("array<float>" if single else "array<double>").alias("v"),
                          is_query.alias("q")).filter("id is not null")
    # What takes no part goes before one vector an id is chosen.
    asked = rows.filter(F.col("q") & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & F.exists("v", lambda x: x != 0))
    size = min(TILE, QUERY_BLOCK)
    with Scratch(spark) as scratch:
        queries = written(asked.groupBy("id").agg(F.min("v").alias("v"))
                          .mapInArrow(lambda it: _tiles(it, dtype, size), TILES), "query-tiles")
        per_block = QUERY_BLOCK // size
        blocks = -(-queries.count() // per_block)
        if not blocks:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        n_rows = rows.count()
        # A small table is cut finer, to give every core a group.
        groups = max(-(-n_rows // ROW_GROUP), min(spark.sparkContext.defaultParallelism, -(-n_rows // TILE)))
        tiles = rows.select("id", "v").mapInArrow(lambda it: _tiles(it, dtype, TILE), TILES)

        def every(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
        columns = ["qb", "rg", "is_row", "width", "ids", "data"]
        cells = (_numbered(queries, per_block).select("*", every(groups).alias("rg"), F.lit(False).alias("is_row")).select(*columns)
                 .unionByName(tiles.select("*", F.pmod(F.xxhash64("part", "seq"), F.lit(groups)).alias("rg"),
                                           every(blocks).alias("qb"), F.lit(True).alias("is_row")).select(*columns)))
        cells = cells.repartition(blocks * groups, "qb", "rg").sortWithinPartitions("qb", "rg", "is_row")
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        with batches_of(spark, 4 * TILE):  # bounded in bytes; vectors and tiles are far from it in number
            found = cells.mapInArrow(lambda it: _cells(it, dtype, k), "query_id long, vec_id long, score double")
            return scratch.keep(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                                .select("query_id", "rank", "vec_id", "score"), "neighbours")
