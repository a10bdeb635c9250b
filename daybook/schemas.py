"""Column names and fixed schemas of the transaction, staging and metric tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the reference's data model, in its order.
ORDER_DATE = "order_date"
ORDER_ID = "order_id"
BUYER_ID = "buyer_id"
ORDER_TS = "order_timestamp"
PRODUCT_ID = "product_id"
QUANTITY = "quantity"
UNIT_PRICE = "unit_price"
REVENUE = "revenue"
PAYMENT_METHOD = "payment_method"
PARTITION_KEYS = ("year", "month", "date")  # Hive layout of the source; `date` is the day of month

STAGING_COLUMNS = (
    ORDER_DATE,
    ORDER_ID,
    BUYER_ID,
    ORDER_TS,
    PRODUCT_ID,
    QUANTITY,
    UNIT_PRICE,
    REVENUE,
    PAYMENT_METHOD,
)

DAILY_REVENUE = "daily_revenue"
DAILY_ORDERS = "daily_orders"
DAILY_BUYERS = "daily_buyers"
RUNNING_REVENUE = "running_revenue"

# v1 / v2 metric tables
DAILY_COLUMNS = (ORDER_DATE, DAILY_REVENUE, DAILY_ORDERS)
# v3 metric table
RUNNING_COLUMNS = (ORDER_DATE, DAILY_REVENUE, DAILY_ORDERS, DAILY_BUYERS, RUNNING_REVENUE)

# The reference keys are strings (UUIDs, `buyer_<n>`); the test adapters keep bigint keys.
# No operator depends on the key type, so the staging schema is built from the key type.


def transaction_schema(key_type: T.DataType = T.StringType()) -> T.StructType:
    """Source rows at order-line grain (without the Hive partition columns)."""
    return T.StructType(
        [
            T.StructField(ORDER_ID, key_type),
            T.StructField(BUYER_ID, key_type),
            T.StructField(ORDER_DATE, T.DateType()),
            T.StructField(ORDER_TS, T.TimestampNTZType()),
            T.StructField(PRODUCT_ID, T.LongType()),
            T.StructField(QUANTITY, T.LongType()),
            T.StructField(UNIT_PRICE, T.DoubleType()),
            T.StructField(REVENUE, T.DoubleType()),
            T.StructField(PAYMENT_METHOD, T.StringType()),
        ]
    )


def staging_schema(key_type: T.DataType = T.StringType()) -> T.StructType:
    by_name = {f.name: f for f in transaction_schema(key_type).fields}
    return T.StructType([by_name[c] for c in STAGING_COLUMNS])


DAILY_SCHEMA = T.StructType(
    [
        T.StructField(ORDER_DATE, T.DateType()),
        T.StructField(DAILY_REVENUE, T.DoubleType()),
        T.StructField(DAILY_ORDERS, T.LongType()),
    ]
)

RUNNING_SCHEMA = T.StructType(
    [
        T.StructField(ORDER_DATE, T.DateType()),
        T.StructField(DAILY_REVENUE, T.DoubleType()),
        T.StructField(DAILY_ORDERS, T.LongType()),
        T.StructField(DAILY_BUYERS, T.LongType()),
        T.StructField(RUNNING_REVENUE, T.DoubleType()),
    ]
)
