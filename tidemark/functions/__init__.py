"""Column expressions shared by the operators (all JVM-side built-ins)."""

from tidemark.functions.expressions import (  # noqa: F401
    as_at_condition,
    calendar_columns,
    date_key,
    failed_status,
    gross_amount,
    net_amount,
    null_safe_difference,
    quote_identifier,
    ts_literal,
    window_predicate,
)
