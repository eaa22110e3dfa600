"""Declared schemas and sentinel values.

Nothing is inferred: every table the loader reads or writes has a fixed
StructType here. Timestamps are TIMESTAMP_NTZ throughout (wall-clock values
with no zone), so sentinels survive any session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import types as T

# --- Fixed values (must equal the behaviour being reproduced) ---------------
# Open end of a validity window: a sentinel, never NULL.
END_OF_TIME = datetime(9999, 12, 31, 23, 59, 59)
# A first-seen dimension member opens here, not at load time.
BEGINNING_OF_TIME = datetime(1900, 1, 1)
# Watermark of a stream that never ran.
EPOCH = datetime(1900, 1, 1)
# Trailing re-read subtracted from the low-water mark on warm starts.
DEFAULT_LOOKBACK = timedelta(days=2)
# The inferred member every unresolved fact points at.
UNKNOWN_SK = -1
UNKNOWN_BK = "UNKNOWN"
UNKNOWN_LABEL = "Unknown"
# Tracked attributes of the two dimensions.
CUSTOMER_ATTRIBUTES = ["customer_name", "segment", "country", "credit_rating"]
PRODUCT_ATTRIBUTES = ["product_name", "category", "unit_cost"]
# Run statuses.
STATUS_RUNNING = "RUNNING"
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED_PREFIX = "FAILED: "
STATUS_MAX_LEN = 200
# Default calendar range of the date dimension.
DEFAULT_DATE_START = "2025-01-01"
DEFAULT_DATE_END = "2027-12-31"
# The one stream the loader keys its watermark on.
SALES_STREAM = "sales"
# ----------------------------------------------------------------------------

TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(9, 4)


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SRC_CUSTOMER = _s(
    ("customer_id", T.StringType(), False),
    ("customer_name", T.StringType(), True),
    ("segment", T.StringType(), True),
    ("country", T.StringType(), True),
    ("credit_rating", T.StringType(), True),
    ("updated_at", TS, False),
)

SRC_PRODUCT = _s(
    ("product_id", T.StringType(), False),
    ("product_name", T.StringType(), True),
    ("category", T.StringType(), True),
    ("unit_cost", MONEY, True),
    ("updated_at", TS, False),
)

SRC_ORDER_LINE = _s(
    ("order_line_id", T.StringType(), False),
    ("order_id", T.StringType(), False),
    ("order_ts", TS, False),
    ("customer_id", T.StringType(), False),
    ("product_id", T.StringType(), False),
    ("quantity", T.IntegerType(), False),
    ("unit_price", MONEY, False),
    ("discount_pct", RATE, False),
    ("updated_at", TS, False),
)

DIM_CUSTOMER = _s(
    ("sk", T.LongType(), False),
    ("customer_id", T.StringType(), False),
    ("customer_name", T.StringType(), True),
    ("segment", T.StringType(), True),
    ("country", T.StringType(), True),
    ("credit_rating", T.StringType(), True),
    ("valid_from", TS, False),
    ("valid_to", TS, False),
    ("is_current", T.BooleanType(), False),
)

DIM_PRODUCT = _s(
    ("product_id", T.StringType(), False),
    ("product_name", T.StringType(), True),
    ("category", T.StringType(), True),
    ("unit_cost", MONEY, True),
    ("updated_at", TS, True),
)

DIM_DATE = _s(
    ("date_key", T.IntegerType(), False),
    ("full_date", T.DateType(), False),
    ("year", T.IntegerType(), True),
    ("quarter", T.IntegerType(), True),
    ("month", T.IntegerType(), True),
    ("month_name", T.StringType(), True),
    ("day_of_month", T.IntegerType(), True),
    ("day_of_week", T.IntegerType(), True),
    ("day_name", T.StringType(), True),
    ("is_weekend", T.BooleanType(), True),
)

FACT_ORDER_LINE = _s(
    ("order_line_id", T.StringType(), False),
    ("order_id", T.StringType(), False),
    ("order_date_key", T.IntegerType(), False),
    ("customer_sk", T.LongType(), False),
    ("product_id", T.StringType(), False),
    ("quantity", T.IntegerType(), False),
    ("unit_price", MONEY, False),
    ("discount_pct", RATE, False),
    ("gross_amount", MONEY, False),
    ("net_amount", MONEY, False),
    ("source_updated_at", TS, False),
    ("loaded_at", TS, False),
)

WATERMARK = _s(
    ("stream", T.StringType(), False),
    ("watermark", TS, False),
    ("updated_at", TS, False),
)

RUN_LOG = _s(
    ("run_id", T.StringType(), False),
    ("stream", T.StringType(), False),
    ("started_at", TS, False),
    ("finished_at", TS, True),
    ("low_water", TS, True),
    ("high_water", TS, True),
    ("rows_read", T.LongType(), True),
    ("rows_inserted", T.LongType(), True),
    ("rows_updated", T.LongType(), True),
    ("status", T.StringType(), False),
)

# Primary keys and NOT NULL columns the database would enforce; Spark will
# not, so the audits in operators/checks.py verify them instead.
PRIMARY_KEYS = {
    "dim_customer": ["sk"],
    "dim_product": ["product_id"],
    "dim_date": ["date_key"],
    "fact_order_line": ["order_line_id"],
    "etl_watermark": ["stream"],
}

NOT_NULL = {
    name: [f.name for f in schema.fields if not f.nullable]
    for name, schema in {
        "dim_customer": DIM_CUSTOMER,
        "dim_date": DIM_DATE,
        "fact_order_line": FACT_ORDER_LINE,
    }.items()
}


def empty(spark, schema: T.StructType):
    """An empty DataFrame of a declared schema (a table that does not exist yet)."""
    return spark.createDataFrame([], schema)
