"""Watermark-bounded extraction and the run's single high-water mark."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expressions import ts_literal, window_predicate
from tidemark.session import observed, stage


def staged_window(sources: Sequence[DataFrame], low: datetime, mark: datetime, run_ts: datetime,
                  change_column: str = "updated_at") -> tuple[list[DataFrame], datetime]:
    """The sources' rows above ``low``, each staged by one scan, and the run's high-water mark.

    The greatest change time is observed while staging, so the window closes at
    what was read: no row staged lies beyond it, and a row that arrives later is
    left to the next run. Where nothing lies above ``low``, the window closes at
    the stored mark, and without one at the sources' maximum (``run_ts`` if empty).
    """
    staged = [stage(s.where(F.col(change_column) > ts_literal(low)), f"window_{i}", [F.max(change_column).alias("high")]) for i, s in enumerate(sources)]
    seen = [h for s in staged if (h := observed(s)["high"]) is not None]
    if seen:
        return staged, max(seen)
    return staged, mark if mark > schemas.EPOCH else high_water(sources, run_ts, change_column)


def extract(source: DataFrame, low: datetime, high: datetime, columns: Sequence[str] | None = None,
            change_column: str = "updated_at") -> DataFrame:
    """Rows changed in ``(low, high]``, projected to ``columns``.

    Both bounds are literals, so the predicate reaches the Parquet scan as a
    pushed filter and only the projected columns are read.
    """
    rows = source.where(window_predicate(change_column, low, high))
    return rows.select(*columns) if columns else rows


def high_water_frame(sources: Sequence[DataFrame], change_column: str = "updated_at") -> DataFrame:
    """One row: the greatest non-null ``max(change_column)`` over all sources.

    Each maximum is a partial aggregate per task, so this is one small job.
    """
    maxima = [s.agg(F.max(change_column).alias("high_water")) for s in sources]
    return reduce(DataFrame.unionByName, maxima).agg(F.max("high_water").alias("high_water"))


def high_water(sources: Sequence[DataFrame], run_ts: datetime, change_column: str = "updated_at",
               after: datetime | None = None) -> datetime:
    """The run's high-water mark, captured once; ``run_ts`` if every source is empty.

    With ``after`` (the stored mark), rows changed since are looked at first, through
    a pushed filter; only if there are none are the sources read whole.
    """
    if after is not None:
        newer = [s.where(F.col(change_column) > ts_literal(after)) for s in sources]
        value = high_water_frame(newer, change_column).collect()[0]["high_water"]
        if value is not None:
            return value
    value = high_water_frame(sources, change_column).collect()[0]["high_water"]
    return value if value is not None else run_ts
