"""Reader for the Hive-partitioned store-transaction source (``year=/month=/date=`` directories).

* Read the **root** directory: partition discovery then yields ``year``, ``month`` and ``date``
  (day of month) as int columns.  A recursive file glob would drop them.
* ``from_date`` adds the event-time filter on ``order_timestamp`` (pushed to the Parquet scan as a
  timestamp range).  Only if the source is *declared* ``day_aligned`` - every row lies in the folder
  of its timestamp's day, as ``export.partitioned_export`` writes it - are folders pruned too: the
  listing is cut to the months from ``from_date``'s month on, and the same bound on the partition
  date prunes the remaining day folders.  Folders without a date (NULL partition values) are always
  read.  ``misplaced_rows`` counts rows that break the declaration.
* A pandas-written ``TIMESTAMP(NANOS)`` column is read as bigint nanoseconds
  (``spark.sql.legacy.parquet.nanosAsLong``) and normalised to ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.functions.dates import date_lit, parse_date, partition_date
from daybook.sources.fs import list_subdirs, path_exists


def normalise_timestamp(df: DataFrame, column: str = S.ORDER_TS) -> DataFrame:
    """bigint nanoseconds / timestamp with zone -> timestamp_ntz (wall clock in UTC)."""
    if column not in df.columns:
        return df
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.LongType):
        # Exact integer floor division: nanosecond epochs exceed a double's 53-bit mantissa.
        micros = F.expr(f"(`{column}` - pmod(`{column}`, 1000)) div 1000")
        return df.withColumn(column, F.timestamp_micros(micros).cast(T.TimestampNTZType()))
    if isinstance(dtype, T.TimestampType):
        return df.withColumn(column, F.col(column).cast(T.TimestampNTZType()))
    return df


def has_day_folders(df: DataFrame) -> bool:
    return all(k in df.columns for k in S.PARTITION_KEYS)


def window_rows(df: DataFrame, from_date, ts_column: str = S.ORDER_TS, day_aligned: bool = False) -> DataFrame:
    """Event-time lower bound (inclusive); for a day-aligned source the partition bound as well."""
    if from_date is None:
        return df
    if day_aligned and has_day_folders(df):
        day = partition_date()
        df = df.filter((day >= date_lit(from_date)) | day.isNull())
    return df.filter(F.to_date(F.col(ts_column)) >= date_lit(from_date))


def day_rows(df: DataFrame, days, ts_column: str = S.ORDER_TS, day_aligned: bool = False) -> DataFrame:
    """Rows of the given event days; for a day-aligned source from their folders only."""
    days = sorted(days)
    if day_aligned and has_day_folders(df):
        day = partition_date()
        df = df.filter(day.isin(days) | day.isNull())
    return df.filter(F.to_date(F.col(ts_column)).isin(days))


def misplaced_rows(df: DataFrame) -> int:
    """Rows outside the folder of their timestamp's day (NULL folders included)."""
    wrong = ~F.coalesce(partition_date() == F.to_date(F.col(S.ORDER_TS)), F.lit(False))
    return df.filter(F.col(S.ORDER_TS).isNotNull() & wrong).count()


def window_month_paths(spark: SparkSession, root: str, from_date) -> list[str] | None:
    """``year=Y/month=M`` folders of months on or after ``from_date``'s month, found by listing only
    the year and month levels, and every folder with a NULL year, month or day; None when the layout
    is not year/month/day.  Handing these to the file index keeps a 14-day run from listing every
    file of the table's history."""
    d = parse_date(from_date)
    years = list_subdirs(spark, root, "year=")
    if not years:
        return None
    null = "__HIVE_DEFAULT_PARTITION__"
    out = []
    for y_name, y_path in years:
        y = y_name[len("year="):]
        if y == null:
            out.append(y_path)
            continue
        for m_name, m_path in list_subdirs(spark, y_path, "month="):
            m = m_name[len("month="):]
            if m == null or (int(y), int(m)) >= (d.year, d.month):
                out.append(m_path)
            elif path_exists(spark, f"{m_path}/date={null}"):
                out.append(f"{m_path}/date={null}")
    return out


def read_transactions(spark: SparkSession, root: str, from_date=None, schema: T.StructType | None = None,
                      day_aligned: bool = False) -> DataFrame:
    """Scan the partitioned source.  ``schema`` (including the partition columns) skips footer
    inference on very large layouts; without it, the schema is inferred as the reference does."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    paths = [root]
    if from_date is not None and day_aligned:
        paths = window_month_paths(spark, root, from_date) or paths
    return window_rows(normalise_timestamp(reader.parquet(*paths)), from_date, day_aligned=day_aligned)


def partitioned_source_schema(key_type: T.DataType = T.StringType()) -> T.StructType:
    fields = list(S.transaction_schema(key_type).fields)
    fields += [T.StructField(k, T.IntegerType()) for k in S.PARTITION_KEYS]
    return T.StructType(fields)
