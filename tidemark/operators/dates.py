"""The generated date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expressions import as_date, calendar_columns


def calendar(spark: SparkSession, start: str | date = schemas.DEFAULT_DATE_START,
             end: str | date = schemas.DEFAULT_DATE_END) -> DataFrame:
    """Every day from ``start`` to ``end``, both included.

    Generated from a distributed ``range`` (one row per day, split over tasks),
    not by exploding one array in one task.
    """
    s, e = as_date(start), as_date(end)
    days = (e - s).days + 1
    if days <= 0:
        return schemas.empty(spark, schemas.DIM_DATE)
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), days // 366 + 1))
    d = F.date_add(F.lit(s.isoformat()).cast("date"), F.col("id").cast("int"))
    return spark.range(0, days, 1, n).select(*calendar_columns(d))


def missing_days(existing: DataFrame, start: str | date = schemas.DEFAULT_DATE_START,
                 end: str | date = schemas.DEFAULT_DATE_END) -> DataFrame:
    """The days of ``[start, end]`` that the date dimension hasn't got."""
    days = calendar(existing.sparkSession, start, end)
    return days.join(existing.select("date_key"), "date_key", "left_anti").select(*existing.columns)


def build_dim_date(existing: DataFrame, start: str | date = schemas.DEFAULT_DATE_START,
                   end: str | date = schemas.DEFAULT_DATE_END) -> DataFrame:
    """The date dimension with the missing days of ``[start, end]`` added."""
    return existing.unionByName(missing_days(existing, start, end))
