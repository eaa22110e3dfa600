"""Scalar expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas


def quote_identifier(name: str) -> str:
    """Backtick-quote a name for Spark SQL text (embedded backticks doubled)."""
    return "`" + name.replace("`", "``") + "`"


def ts_literal(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone."""
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(schemas.TS)


def null_safe_difference(columns: Sequence[str], left: DataFrame | str, right: DataFrame | str) -> Column:
    """TRUE when any tracked attribute differs, NULLs included (IS DISTINCT FROM).

    ``left``/``right`` are DataFrames (columns resolved on them) or alias names.
    """
    if not columns:
        return F.lit(False)

    def col(side, name):
        return side[name] if isinstance(side, DataFrame) else F.col(f"{side}.{quote_identifier(name)}")

    return reduce(lambda a, b: a | b, [~col(left, c).eqNullSafe(col(right, c)) for c in columns])


def window_predicate(column: str | Column, low: datetime, high: datetime) -> Column:
    """The extract window, open below and closed above: ``low < c <= high``."""
    c = F.col(column) if isinstance(column, str) else column
    return (c > ts_literal(low)) & (c <= ts_literal(high))


def as_at_condition(moment: Column | datetime, valid_from: Column | str = "valid_from",
                    valid_to: Column | str = "valid_to") -> Column:
    """Half-open validity: ``valid_from <= moment < valid_to``."""
    m = ts_literal(moment) if isinstance(moment, datetime) else moment
    vf = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    vt = F.col(valid_to) if isinstance(valid_to, str) else valid_to
    return (m >= vf) & (m < vt)


def date_key(d: Column) -> Column:
    """yyyymmdd as INT (from a date or timestamp)."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The date dimension's columns derived from a DATE column ``d``.

    Month and day names are the full English forms; day_of_week is ISO
    (Monday 1 .. Sunday 7), which is ``weekday + 1`` (``dayofweek`` starts on
    Sunday).
    """
    isodow = (F.weekday(d) + 1).cast("int")
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        isodow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (isodow >= 6).alias("is_weekend"),
    ]


def gross_amount(quantity: Column, unit_price: Column) -> Column:
    """quantity * unit_price at DECIMAL(18,4) (exact: scale 4 in, scale 4 out)."""
    return (quantity.cast("decimal(10,0)") * unit_price).cast(schemas.MONEY)


def net_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """quantity * unit_price * (1 - discount_pct) rounded once to scale 4.

    Written naively, Spark types the product as decimal(38,6) and rounds twice;
    casting the exact gross first keeps the product at decimal(29,8), so the
    final cast is the only rounding (HALF_UP).
    """
    one_minus = (F.lit(1).cast("decimal(1,0)") - discount_pct)
    return (gross_amount(quantity, unit_price) * one_minus).cast(schemas.MONEY)


def failed_status(error: str) -> str:
    """Status text of a failed run, prefix included, cut to 200 characters."""
    return (schemas.STATUS_FAILED_PREFIX + (error or ""))[: schemas.STATUS_MAX_LEN]


def as_date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)
