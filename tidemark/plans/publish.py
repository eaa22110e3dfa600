"""Publishing loads with Spark's writers: appended rows, superseded keys, a one-row commit.

A load only appends: the rows it inserts or changes to a folder of its own
(``<table>/_run=<run>``), and the keys of rows that it replaces, with the run that wrote
those, to ``<table>-gone/<run>``. A table's current rows are those of its runs without the
superseded ones (an anti join), so a load writes as much as it changes, not whole tables.

A commit is one row appended to ``_commits``: each table's runs, their row counts, and notes.
Readers see a load only from then on; folders of a load that died are never named.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.session import BROADCAST_MAX_ROWS, path_exists, with_known_rows

TABLE_SCHEMAS = {
    "dim_customer": schemas.DIM_CUSTOMER,
    "dim_product": schemas.DIM_PRODUCT,
    "dim_date": schemas.DIM_DATE,
    "fact_order_line": schemas.FACT_ORDER_LINE,
    "etl_watermark": schemas.WATERMARK,
    "etl_run_log": schemas.RUN_LOG,
}
#: The key of the rows that a load may supersede.
KEYS = {"dim_customer": "sk", "dim_product": "product_id", "fact_order_line": "order_line_id"}
RUN_COL, MONTH_COL = "_run", "_order_month"
COMMIT_SCHEMA = "seq long, run_id string, runs map<string,array<string>>, rows map<string,long>, notes map<string,string>"


class ConcurrentLoadError(RuntimeError):
    """Another load was committed since this one began."""


@dataclass(frozen=True)
class Manifest:
    seq: int = 0
    runs: dict[str, list[str]] = field(default_factory=dict)  # table or "<table>-gone" -> runs
    rows: dict[str, int] = field(default_factory=dict)  # "<table>/<run>" or "<table>-gone/<run>" -> rows
    notes: dict[str, str] = field(default_factory=dict)

    def written(self, table: str) -> int:
        """Rows stored for a table (or superseded in it, for ``<table>-gone``)."""
        return sum(self.rows[f"{table}/{r}"] for r in self.runs.get(table, []))

    def live(self, table: str) -> int:
        return self.written(table) - self.written(f"{table}-gone")


class Warehouse:
    """A warehouse rooted at a shared directory (HDFS, object store, or local in tests)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> Manifest:
        """The last commit; an empty warehouse has none."""
        if not path_exists(self.spark, f"{self.root}/_commits"):
            return Manifest()
        last = self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.root}/_commits").orderBy(F.desc("seq")).limit(1).collect()[0]
        return Manifest(last["seq"], {t: list(r) for t, r in last["runs"].items()}, dict(last["rows"]), dict(last["notes"]))

    def read(self, table: str, manifest: Manifest | None = None, with_run: bool = False) -> DataFrame:
        """A table's current rows; ``with_run`` adds the run that wrote each."""
        m = self.manifest() if manifest is None else manifest
        stored = T.StructType([*TABLE_SCHEMAS[table].fields, T.StructField(RUN_COL, T.StringType())])
        columns = stored.fieldNames() if with_run else TABLE_SCHEMAS[table].fieldNames()
        if not m.written(table):
            return with_known_rows(schemas.empty(self.spark, stored).select(*columns), 0)
        paths = [f"{self.root}/{table}/{RUN_COL}={r}" for r in m.runs[table] if m.rows[f"{table}/{r}"]]
        df = self.spark.read.schema(stored).option("basePath", f"{self.root}/{table}").parquet(*paths)
        if n := m.written(f"{table}-gone"):
            key = TABLE_SCHEMAS[table][KEYS[table]]
            paths = [f"{self.root}/{table}-gone/{r}" for r in m.runs[f"{table}-gone"] if m.rows[f"{table}-gone/{r}"]]
            gone = self.spark.read.schema(T.StructType([key, T.StructField(RUN_COL, T.StringType())])).parquet(*paths)
            df = df.join(F.broadcast(gone) if n <= BROADCAST_MAX_ROWS // 4 else gone, [key.name, RUN_COL], "left_anti")
        return with_known_rows(df.select(*columns), m.live(table))

    def _write(self, df: DataFrame, base: Manifest, table: str, folder: str, run_id: str, by: str | None = None, metrics: Sequence[Column] = ()) -> tuple[Manifest, dict]:
        """(``base`` with one more run of ``table``, the metrics observed while it was written)."""
        run, seen = f"{run_id}-{uuid.uuid4().hex[:8]}", Observation(f"written_{uuid.uuid4().hex[:8]}")
        writer = df.observe(seen, F.count(F.lit(1)).alias("_n"), *metrics).write.mode("errorifexists").option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{folder}{run}")
        values = dict(seen.get)
        rows = base.rows | {f"{table}/{run}": int(values.pop("_n"))}
        return replace(base, runs=base.runs | {table: [*base.runs.get(table, []), run]}, rows=rows), values

    def append(self, base: Manifest, table: str, rows: DataFrame, run_id: str, gone: DataFrame | None = None) -> Manifest:
        """Write ``rows`` as a run of ``table`` and the (key, run) of the rows they supersede;
        the manifest that holds them, for ``read`` and in the end ``commit``."""
        now, _ = self.append_observed(base, table, rows, run_id)
        return now if gone is None else self.supersede(now, table, gone, run_id)

    def append_observed(self, base: Manifest, table: str, rows: DataFrame, run_id: str, metrics: Sequence[Column] = ()) -> tuple[Manifest, dict]:
        """``append`` with aggregates of the rows, observed by the same write."""
        rows, by = rows.select(*TABLE_SCHEMAS[table].fieldNames()), None
        if table == "fact_order_line":  # by order month, from the tasks that hold the rows: no shuffle
            by = MONTH_COL
            rows = rows.withColumn(MONTH_COL, (F.col("order_date_key") / 100).cast("int"))
        return self._write(rows, base, table, f"{table}/{RUN_COL}=", run_id, by, metrics)

    def supersede(self, base: Manifest, table: str, gone: DataFrame, run_id: str) -> Manifest:
        """Write the (key, run) of rows of ``table`` that are no longer current."""
        return self._write(gone.select(KEYS[table], RUN_COL), base, f"{table}-gone", f"{table}-gone/", run_id)[0]

    def last_run(self, base: Manifest, table: str) -> DataFrame:
        """The rows of the run that was written last, also before its commit."""
        run = base.runs[table][-1]
        df = self.spark.read.schema(TABLE_SCHEMAS[table]).parquet(f"{self.root}/{table}/{RUN_COL}={run}")
        return with_known_rows(df.select(*TABLE_SCHEMAS[table].fieldNames()), base.rows[f"{table}/{run}"])

    def rewrite(self, base: Manifest, table: str, rows: DataFrame, run_id: str) -> Manifest:
        """``rows`` as the whole of ``table``: one run, nothing superseded."""
        return self.append(replace(base, runs=base.runs | {table: [], f"{table}-gone": []}), table, rows, run_id)

    def compact(self, base: Manifest, table: str, run_id: str) -> Manifest:
        """The table's current rows written as one run."""
        return self.rewrite(base, table, self.read(table, base), run_id)

    def commit(self, base: Manifest, run_id: str, notes: dict[str, str] | None = None) -> Manifest:
        """Append the one row that makes what ``base`` names current."""
        if (now := self.manifest().seq) != base.seq:
            raise ConcurrentLoadError(f"the warehouse moved from commit {base.seq} to {now} during the run")
        named = {f"{t}/{r}" for t, runs in base.runs.items() for r in runs}
        done = replace(base, seq=base.seq + 1, rows={k: n for k, n in base.rows.items() if k in named}, notes=base.notes | (notes or {}))
        row = [(done.seq, run_id, done.runs, done.rows, done.notes)]
        self.spark.createDataFrame(row, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")
        return done
