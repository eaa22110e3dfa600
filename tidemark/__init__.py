"""tidemark: incremental star-schema loading on Spark.

Watermark-bounded extraction with a lookback, Type 1 and Type 2 dimension
loads, as-at surrogate resolution for facts, idempotent fact merges, a
generated date dimension, history validation, audits and reports, all as
DataFrame operators.
"""

from tidemark.schemas import (  # noqa: F401
    BEGINNING_OF_TIME,
    CUSTOMER_ATTRIBUTES,
    DEFAULT_LOOKBACK,
    END_OF_TIME,
    EPOCH,
    PRODUCT_ATTRIBUTES,
    UNKNOWN_SK,
)

__version__ = "0.1.0"
