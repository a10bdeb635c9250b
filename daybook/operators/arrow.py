"""Arrow-batch variants of the daily metrics (the reference's Python models).

``batches`` (``mapInArrow``): each task turns its Arrow record batches (100,000 rows, the
reference's batch size) into per-batch partials - revenue units per day and the distinct
(day, order) and (day, buyer) pairs of the batch - with pyarrow kernels; a native aggregation then
merges them.  Nothing is buffered beyond one batch, and the Python step only shrinks the data
before the shuffle, like a map-side combine.

``grouped`` (``applyInArrow``): Python sees one group at a time.  Grouping raw rows by day would put
a whole day - possibly a third of all rows - into one call, so rows are first pre-aggregated
natively to one row per (day, order) and per (day, buyer), then grouped by a hash bucket of the
key, and each bucket is streamed batch by batch.  A native sum merges the buckets.

Both give the same result as the native plan (SQL semantics: NULL revenue skipped, an all-NULL day
gives NULL, NULL keys not counted).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.functions.money import MONEY_SCALE, from_units, to_units
from daybook.operators.metrics import in_window

_UNITS = "units"
_BUCKET = "bucket"
_TOTAL = pa.decimal128(38, 0)


def _units(arr: pa.ChunkedArray) -> pa.ChunkedArray:
    number = pc.if_else(pc.is_finite(arr), arr, pa.scalar(None, arr.type))
    rounded = pc.round(pc.multiply(number, float(MONEY_SCALE)), round_mode="half_to_even")
    return pc.cast(pc.cast(rounded, pa.int64()), _TOTAL)


def _partials_fn(with_buyers: bool):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            t = pa.Table.from_batches([batch])
            t = t.append_column(_UNITS, _units(t[S.REVENUE]))
            oid_type = t.schema.field(S.ORDER_ID).type
            bid_type = t.schema.field(S.BUYER_ID).type if with_buyers else None
            day_sum = t.group_by(S.ORDER_DATE, use_threads=False).aggregate([(_UNITS, "sum")])
            pairs = [
                (day_sum[S.ORDER_DATE], day_sum[f"{_UNITS}_sum"], None, None),
            ]
            orders = t.group_by([S.ORDER_DATE, S.ORDER_ID], use_threads=False).aggregate([])
            pairs.append((orders[S.ORDER_DATE], None, orders[S.ORDER_ID], None))
            if with_buyers:
                buyers = t.group_by([S.ORDER_DATE, S.BUYER_ID], use_threads=False).aggregate([])
                pairs.append((buyers[S.ORDER_DATE], None, None, buyers[S.BUYER_ID]))
            for day, units, oid, bid in pairs:
                n = len(day)
                cols = [day.combine_chunks(),
                        units.combine_chunks() if units is not None else pa.nulls(n, _TOTAL),
                        oid.combine_chunks() if oid is not None else pa.nulls(n, oid_type)]
                names = [S.ORDER_DATE, _UNITS, S.ORDER_ID]
                if with_buyers:
                    cols.append(bid.combine_chunks() if bid is not None else pa.nulls(n, bid_type))
                    names.append(S.BUYER_ID)
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return fn


def _field(df: DataFrame, name: str) -> T.StructField:
    return df.schema[name]


def daily_metrics_batches(staged: DataFrame, from_date=None, with_buyers: bool = True) -> DataFrame:
    """U1: per-batch Arrow partials, native final merge."""
    cols = [S.ORDER_DATE, S.ORDER_ID, S.REVENUE] + ([S.BUYER_ID] if with_buyers else [])
    src = in_window(staged, from_date).select(*cols)
    out_fields = [T.StructField(S.ORDER_DATE, T.DateType()), T.StructField(_UNITS, T.DecimalType(38, 0)),
                  T.StructField(S.ORDER_ID, _field(src, S.ORDER_ID).dataType)]
    if with_buyers:
        out_fields.append(T.StructField(S.BUYER_ID, _field(src, S.BUYER_ID).dataType))
    partials = src.mapInArrow(_partials_fn(with_buyers), T.StructType(out_fields))
    aggs = [from_units(F.sum(_UNITS)).alias(S.DAILY_REVENUE),
            F.count_distinct(S.ORDER_ID).alias(S.DAILY_ORDERS)]
    if with_buyers:
        aggs.append(F.count_distinct(S.BUYER_ID).alias(S.DAILY_BUYERS))
    return partials.groupBy(S.ORDER_DATE).agg(*aggs)


def _bucket_days(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash bucket of pre-aggregated rows (order_date, tag, units, k) -> per day and tag the
    revenue units and the count of non-NULL keys.  Batch by batch: only one row per day and tag is
    held, and a native sum merges the buckets' rows."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t.set_column(t.schema.get_field_index(_UNITS), _UNITS, pc.cast(t[_UNITS], _TOTAL))
        t = t.group_by([S.ORDER_DATE, "tag"], use_threads=False).aggregate([(_UNITS, "sum"), ("k", "count")]).rename_columns([S.ORDER_DATE, "tag", _UNITS, "n"])
        t = t.set_column(3, "n", pc.cast(t["n"], pa.int64())) if held is None else \
            pa.concat_tables([held, t.set_column(3, "n", pc.cast(t["n"], pa.int64()))])
        t = t.group_by([S.ORDER_DATE, "tag"], use_threads=False).aggregate([(_UNITS, "sum"), ("n", "sum")])
        held = t.rename_columns([S.ORDER_DATE, "tag", _UNITS, "n"])
    if held is not None:
        yield from held.to_batches()


def daily_metrics_grouped(staged: DataFrame, from_date=None, with_buyers: bool = True,
                          buckets: int | None = None) -> DataFrame:
    """U2: grouped Arrow aggregation over bounded hash buckets.

    The source is read once.  Each row gives one entry for its order (with its revenue) and one for
    its buyer, told apart by a tag; they are pre-aggregated natively to one row per (day, tag, key)
    and grouped by a hash bucket of the key, so a hot day is spread over all buckets and a hot key
    is already one row.  A bucket is streamed in Arrow batches, never held whole."""
    spark = staged.sparkSession
    nb = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = in_window(staged, from_date)
    entries = [F.struct(F.lit(0).alias("tag"), F.col(S.ORDER_ID).cast("string").alias("k"), to_units(S.REVENUE).alias(_UNITS))]
    if with_buyers:
        entries.append(F.struct(F.lit(1).alias("tag"), F.col(S.BUYER_ID).cast("string").alias("k"),
                                F.lit(None).cast("long").alias(_UNITS)))
    pairs = src.select(S.ORDER_DATE, F.inline(F.array(*entries)))
    once = (pairs.groupBy(S.ORDER_DATE, "tag", "k").agg(F.sum(_UNITS).alias(_UNITS))
            .withColumn(_BUCKET, F.pmod(F.xxhash64("k"), F.lit(nb))))
    parts = once.groupBy(_BUCKET).applyInArrow(_bucket_days, f"{S.ORDER_DATE} date, tag int, {_UNITS} decimal(38,0), n long")
    counted = [from_units(F.sum(_UNITS)).alias(S.DAILY_REVENUE)]
    for tag, name in ((0, S.DAILY_ORDERS), (1, S.DAILY_BUYERS))[: 2 if with_buyers else 1]:
        counted.append(F.coalesce(F.sum(F.when(F.col("tag") == tag, F.col("n"))), F.lit(0)).cast("long").alias(name))
    return parts.groupBy(S.ORDER_DATE).agg(*counted)
