"""Session helpers: configuration for tests and benches, the shared scratch
folder, and the size checks that gate every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side that is ever broadcast: in rows, and in bytes as written to the
# shared folder where the side was staged (wide attributes).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tidemark") -> SparkSession:
    """A session configured the way the library expects (tests and bench).

    On a cluster the caller builds its own session; the library only relies on
    AQE being on and the session time zone being irrelevant (TIMESTAMP_NTZ).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and run-scoped tables.

    Read from the session (``spark.checkpoint.dir`` / the context's checkpoint
    directory). Only a local-mode session with none set gets a fresh private
    folder, as tests do; a cluster session without one is an error, because a
    machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before loading")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh run-scoped directory under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex[:12]}"


_ROWS_ATTR = "_tidemark_rows"
_BYTES_ATTR = "_tidemark_bytes"


def stage(df: DataFrame, name: str = "stage", metrics: list | None = None, codec: str = "snappy") -> DataFrame:
    """Materialise a DataFrame reliably (read once, use many; P3).

    The rows are written as Parquet to a fresh directory under the shared
    checkpoint folder and read back, in one job: a lost executor cannot force
    a re-read of a source that has moved on, lineage is cut, and later reads
    get column pruning and pushed filters. The row count is observed during
    the same write, so size checks on staged data cost no extra job; further
    aggregate ``metrics`` (named Columns) are observed the same way and read
    back with ``observed(staged)``. ``codec`` compresses what is written, which the
    bounds on bytes are meant for: only tables that are never broadcast name another.
    """
    from pyspark.sql import Observation

    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (mine := _STAGED.get()) is not None:
        mine.append(path)
    obs = Observation(f"tidemark_{uuid.uuid4().hex[:8]}")
    # The observation sits on top of the plan, in the writing (result) stage,
    # whose task updates Spark applies once per partition even under retries.
    df.observe(obs, F.count(F.lit(1)).alias("_n"), *(metrics or [])).write.mode("errorifexists").option("compression", codec).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    values = dict(obs.get)
    setattr(staged, _ROWS_ATTR, int(values.pop("_n")))
    setattr(staged, _METRICS_ATTR, values)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    setattr(staged, _BYTES_ATTR, int(fs.getContentSummary(folder).getLength()))
    return staged


_METRICS_ATTR = "_tidemark_metrics"
# Directories written by ``stage`` within the innermost ``staging`` block. Each
# thread has its own, so runs side by side don't touch each other's.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging():
    """Collects the directories that ``stage`` writes inside the block."""
    token = _STAGED.set([])
    try:
        yield _STAGED.get()
    finally:
        _STAGED.reset(token)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Recursively delete directories on any Hadoop-supported store."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def observed(df: DataFrame) -> dict:
    """Metrics observed while ``df`` was staged."""
    return dict(getattr(df, _METRICS_ATTR, {}))


def with_known_rows(df: DataFrame, rows: int) -> DataFrame:
    """Mark ``df`` as having ``rows`` rows (counted while it was written)."""
    setattr(df, _ROWS_ATTR, int(rows))
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory exists, on any Hadoop-supported store."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a directory; fails if ``target`` exists (checked by the file system)."""
    sc = spark.sparkContext
    fs = sc._jvm.org.apache.hadoop.fs
    src, dst = fs.Path(source), fs.Path(target)
    context = fs.FileContext.getFileContext(src.toUri(), sc._jsc.hadoopConfiguration())
    context.mkdir(dst.getParent(), fs.permission.FsPermission.getDirDefault(), True)
    context.rename(src, dst, sc._gateway.new_array(getattr(fs, "Options$Rename"), 0))


def narrowed(staged: DataFrame, *columns: str) -> DataFrame:
    """Some columns of a staged DataFrame, with its known size (an upper bound in bytes)."""
    out = with_known_rows(staged.select(*columns), row_count(staged))
    setattr(out, _BYTES_ATTR, getattr(staged, _BYTES_ATTR, 0))
    return out


def known_rows(df: DataFrame) -> int | None:
    """The row count of a staged DataFrame, if it is known without a job."""
    return getattr(df, _ROWS_ATTR, None)


# Rows per range partition when a sort is split by range: enough work per task
# to amortise its overhead, small enough to sort in memory.
ROWS_PER_RANGE_PARTITION = 1_000_000


def range_partitions(rows: int | None, spark: SparkSession) -> int:
    """Partitions for a range-partitioned sort of ``rows`` rows (known count),
    or the session's shuffle partitions when the count is unknown."""
    if rows is None:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, -(-rows // ROWS_PER_RANGE_PARTITION))


def row_count(df: DataFrame) -> int:
    known = getattr(df, _ROWS_ATTR, None)
    if known is not None:
        return known
    return int(df.select(F.count(F.lit(1)).alias("n")).collect()[0]["n"])


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and, if it was staged, at
    most ``BROADCAST_MAX_BYTES`` bytes.

    A distributed count (partial counts per task, one row per task to the
    driver); a ``limit`` would funnel rows through a single partition.
    """
    bound = broadcast_bound() if max_rows is None else max_rows
    return getattr(df, _BYTES_ATTR, 0) <= BROADCAST_MAX_BYTES and row_count(df) <= bound


def broadcast_bound() -> int:
    """The row bound for broadcasts (``BROADCAST_MAX_ROWS``, read at call time)."""
    return BROADCAST_MAX_ROWS
