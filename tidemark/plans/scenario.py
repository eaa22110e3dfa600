"""The two-load scenario over the given tables, shared by the registered
queries, the bench and the end-to-end tests.

Load 1 reads source v1 from an empty warehouse; load 2 reads source v2 with
the default 2-day lookback. The source's tables are written once as Parquet
tables (as a real source system would hold them); both versions of the order
lines are read from one table of them, row by row. The calendar of the date dimension spans the years of the
order dates found in ``orders``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.plans.publish import Manifest, Warehouse
from tidemark.plans.run import LoadReport, WarehouseState, read_state, run
from tidemark.session import scratch_path, stage
from tidemark.sources import fixtures
from tidemark.sources.tables import read_table

# --- Fixed values of the scenario ------------------------------------------
RUN1_TS = datetime(2026, 1, 1, 0, 0, 0)
RUN2_TS = datetime(2026, 1, 2, 0, 0, 0)
RUN3_TS = datetime(2026, 1, 3, 0, 0, 0)
# ----------------------------------------------------------------------------


@dataclass
class Scenario:
    spark: SparkSession
    sf_dir: str
    warehouse: Warehouse
    v1: fixtures.SourceSnapshot
    v2: fixtures.SourceSnapshot
    date_start: date
    date_end: date
    report1: LoadReport
    report2: LoadReport
    manifest1: Manifest
    manifest2: Manifest
    state1: WarehouseState
    state2: WarehouseState
    extra: dict = field(default_factory=dict)


_CACHE: dict = {}


def calendar_range(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """Whole years covering the order dates in ``orders``."""
    row = read_table(spark, sf_dir, "orders").agg(
        F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi")).collect()[0]
    return date(int(row["lo"]), 1, 1), date(int(row["hi"]), 12, 31)


def materialise_sources(spark: SparkSession, sf_dir: str) -> tuple[fixtures.SourceSnapshot, fixtures.SourceSnapshot]:
    base_lines = stage(fixtures.lines(spark, sf_dir), "lines", codec="zstd")
    out = []
    for v in (1, 2):
        snap = fixtures.snapshot(spark, sf_dir, v, base_lines)
        out.append(fixtures.SourceSnapshot(
            customer=stage(snap.customer, f"src_customer_v{v}"),
            product=stage(snap.product, f"src_product_v{v}"),
            order_line=snap.order_line))  # both versions read the one table of lines
    return out[0], out[1]


def build(spark: SparkSession, sf_dir: str) -> Scenario:
    v1, v2 = materialise_sources(spark, sf_dir)
    start, end = calendar_range(spark, sf_dir)
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    r1 = run(spark, wh, v1, run_ts=RUN1_TS, date_start=start, date_end=end, run_id="load1", keep_staging=True)
    m1 = r1.details["manifest"]
    r2 = run(spark, wh, v2, run_ts=RUN2_TS, date_start=start, date_end=end, run_id="load2", keep_staging=True)
    m2 = r2.details["manifest"]
    return Scenario(spark, sf_dir, wh, v1, v2, start, end, r1, r2, m1, m2,
                    read_state(wh, m1), read_state(wh, m2))


def get(spark: SparkSession, sf_dir: str) -> Scenario:
    """The scenario for this session and data directory (built once)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = build(spark, sf_dir)
    return _CACHE[key]


def empty_state(sc: Scenario) -> WarehouseState:
    """The warehouse before any load."""
    return read_state(sc.warehouse, Manifest())


def zero_lookback_window(sc: Scenario) -> tuple[datetime, datetime]:
    return sc.report1.high_water, sc.report2.high_water
