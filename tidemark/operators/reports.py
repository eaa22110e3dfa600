"""The warehouse reports: counts, history, run log, revenue as booked."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each table, one small job."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def customers_with_history(dim: DataFrame, business_key: str = "customer_id") -> DataFrame:
    """Members with more than one version: ``(key, versions)``."""
    return (dim.groupBy(business_key).agg(F.count(F.lit(1)).cast("long").alias("versions"))
            .where(F.col("versions") > 1))


def run_log_report(run_log: DataFrame) -> DataFrame:
    """The run log by start time, missing counts shown as 0."""
    return run_log.select(
        "run_id", "stream", "started_at", "low_water", "high_water",
        F.coalesce(F.col("rows_read"), F.lit(0)).cast("long").alias("rows_read"),
        F.coalesce(F.col("rows_inserted"), F.lit(0)).cast("long").alias("rows_inserted"),
        F.coalesce(F.col("rows_updated"), F.lit(0)).cast("long").alias("rows_updated"),
        "status",
    ).orderBy("started_at")


def segment_revenue(fact: DataFrame, dim: DataFrame, attribute: str = "segment") -> DataFrame:
    """Net revenue by segment as booked: ``(segment, lines, net)``, net rounded
    to 2 places, largest first. NULL segment is its own group.

    Facts join on the surrogate key they were booked with, so history never
    restates. They are summed per key first (map-side partial aggregation), so
    the join sees one row per surrogate key however hot a key is (the Unknown
    member), and the dimension side is the smaller input.
    """
    per_sk = fact.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("net_amount").alias("_net"))
    dim_side = dim.select(F.col("sk").alias("customer_sk"), F.col(attribute))
    joined = per_sk.join(dim_side, "customer_sk")
    out = joined.groupBy(attribute).agg(
        F.sum("_lines").cast("long").alias("lines"),
        F.round(F.sum("_net"), 2).cast("decimal(38,2)").alias("net"))
    return out.orderBy(F.col("net").desc_nulls_last())
