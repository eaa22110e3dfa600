"""Dense surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` plans every row into one task. Instead:
range-partition on the order, sort within partitions, and number rows inside
each partition (the record counter of ``monotonically_increasing_id`` is the
row's position within its partition); the partition's start offset comes from
a per-partition count, a table with one row per partition. The staged result
is checkpointed because range bounds are sampled: a recomputation could move a
row to another partition and break the numbering.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import known_rows, range_partitions, stage

_LOW_BITS = (1 << 33) - 1


def _order_columns(order: Sequence[str | Column]) -> list[Column]:
    # Ascending with NULLs last, the order of the reference's database.
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def partition_offsets(df: DataFrame, pid_col: str, weight: Column | None = None) -> DataFrame:
    """``(pid, _offset)``: the number (or total weight) of rows in all earlier
    partitions. The per-partition counts are one row per partition, so they
    are collected and cumulated on the driver and come back as a broadcast
    table of the same bounded size."""
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = sorted((r[0], int(r[1] or 0)) for r in df.groupBy(pid_col).agg(w.alias("_c")).collect())
    rows, running = [], 0
    for pid, c in counts:
        rows.append((pid, running))
        running += c
    return F.broadcast(df.sparkSession.createDataFrame(rows, f"{pid_col} bigint, _offset bigint"))


def assign_dense_keys(df: DataFrame, order: Sequence[str | Column], base: int | Column,
                      out_col: str = "sk", num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col = base + 1, base + 2, ...`` in the order given.

    The order must be total (unique) for the numbering to be deterministic.
    """
    spark = df.sparkSession
    # Partition count follows the number of rows to number (known when the
    # input was staged): one partition needs no sampling job, a large input
    # spreads over many.
    n = num_partitions or range_partitions(known_rows(df), spark)
    cols = _order_columns(order)
    numbered = (df.repartitionByRange(n, *cols)
                .sortWithinPartitions(*cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    numbered = stage(numbered)
    numbered = numbered.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
    offsets = partition_offsets(numbered, "_pid")
    base_col = base if isinstance(base, Column) else F.lit(int(base))
    return (numbered.join(offsets, "_pid")
            .withColumn(out_col, (base_col + F.col("_offset") + F.col("_pos") + F.lit(1)).cast("long"))
            .drop("_mid", "_pid", "_pos", "_offset"))
