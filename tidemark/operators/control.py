"""Incremental control: the per-stream watermark store and the run log.

Both are tiny control tables, held as DataFrames and updated functionally
(every operation returns the next table). The rules:

* the extract window is ``(low, high]``, with ``high`` captured once per run;
* ``low`` is the stored mark minus a lookback, except on a cold start (no
  mark), which reads from the epoch;
* the mark advances to ``high`` only after the load it covers is published,
  and a failed run leaves it untouched.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expressions import failed_status, ts_literal


@dataclass(frozen=True)
class RunContext:
    run_id: str
    stream: str
    low_water: datetime
    high_water: datetime
    started_at: datetime


def empty_watermarks(spark: SparkSession) -> DataFrame:
    return schemas.empty(spark, schemas.WATERMARK)


def empty_run_log(spark: SparkSession) -> DataFrame:
    return schemas.empty(spark, schemas.RUN_LOG)


def get_watermark(store: DataFrame, stream: str) -> datetime:
    """The stream's mark; the epoch if it never ran."""
    rows = store.where(F.col("stream") == stream).select("watermark").collect()
    return rows[0]["watermark"] if rows else schemas.EPOCH


def window_bounds(mark: datetime, high_water: datetime,
                  lookback: timedelta = schemas.DEFAULT_LOOKBACK) -> tuple[datetime, datetime]:
    """``(low, high)``: the epoch on a cold start, else mark - lookback."""
    low = schemas.EPOCH if mark == schemas.EPOCH else mark - lookback
    return low, high_water


def low_water(mark: Column, lookback: timedelta = schemas.DEFAULT_LOOKBACK) -> Column:
    """The low bound of ``window_bounds`` as a column of the stored mark."""
    back = F.lit(lookback // timedelta(microseconds=1)).cast("long")
    return F.when(mark == ts_literal(schemas.EPOCH), mark).otherwise(F.timestamp_add("MICROSECOND", -back, mark))


def begin(store: DataFrame, run_log: DataFrame, stream: str, high_water: datetime,
          lookback: timedelta = schemas.DEFAULT_LOOKBACK, now: datetime | None = None,
          run_id: str | None = None) -> tuple[RunContext, DataFrame]:
    """Open a run: compute the window and append a RUNNING row to the log."""
    low, high = window_bounds(get_watermark(store, stream), high_water, lookback)
    ctx = RunContext(run_id=run_id or uuid.uuid4().hex[:12], stream=stream, low_water=low,
                     high_water=high, started_at=now or datetime.now())
    row = run_log.sparkSession.createDataFrame(
        [(ctx.run_id, ctx.stream, ctx.started_at, None, ctx.low_water, ctx.high_water,
          None, None, None, schemas.STATUS_RUNNING)], schemas.RUN_LOG)
    return ctx, run_log.unionByName(row)


def _close_run(run_log: DataFrame, ctx: RunContext, finished_at: datetime, status: str,
               counts: tuple[int, int, int] | None) -> DataFrame:
    this = (F.col("run_id") == ctx.run_id) & (F.col("stream") == ctx.stream)
    cols = []
    for f in schemas.RUN_LOG.fields:
        c = F.col(f.name)
        if f.name == "finished_at":
            c = F.when(this, ts_literal(finished_at)).otherwise(c)
        elif f.name == "status":
            c = F.when(this, F.lit(status)).otherwise(c)
        elif counts is not None and f.name in ("rows_read", "rows_inserted", "rows_updated"):
            value = counts[("rows_read", "rows_inserted", "rows_updated").index(f.name)]
            c = F.when(this, F.lit(int(value)).cast("long")).otherwise(c)
        cols.append(c.alias(f.name))
    return run_log.select(*cols)


def commit(store: DataFrame, run_log: DataFrame, ctx: RunContext, rows_read: int,
           rows_inserted: int = 0, rows_updated: int = 0,
           now: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Advance the mark to the run's high-water mark (upsert), then log SUCCESS."""
    now = now or datetime.now()
    new_row = store.sparkSession.createDataFrame([(ctx.stream, ctx.high_water, now)], schemas.WATERMARK)
    store = store.where(F.col("stream") != ctx.stream).unionByName(new_row)
    log = _close_run(run_log, ctx, now, schemas.STATUS_SUCCESS, (rows_read, rows_inserted, rows_updated))
    return store, log


def fail(run_log: DataFrame, ctx: RunContext, error: str = "", now: datetime | None = None) -> DataFrame:
    """Log ``FAILED: <error>`` (200 characters at most); the mark stays."""
    return _close_run(run_log, ctx, now or datetime.now(), failed_status(error), None)


def reset(store: DataFrame, stream: str | None = None) -> DataFrame:
    """Forget one stream's mark (or every mark when ``stream`` is None)."""
    if stream is None:
        return store.where(F.lit(False))
    return store.where(F.col("stream") != stream)
