"""As-at resolution by one sorted sweep.

Versions and facts are sorted together by (key, time), a version before the facts of its
instant. Each fact's version is the last one before it, so the work is linear in both however
many versions a key has; a join on the key meets every version of a key with each of its facts.
The sort is cut into range partitions, so a hot key spans several. The last version of each
partition (one row per partition) is carried into the next ones as a seed.

Only a history without overlapping windows has one version at most at each time. Keys whose
windows overlap are named by ``overlapping_keys`` and belong to a join that fans out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import range_partitions, row_count, stage

_ORDER = ["_k", "_t", "_kind", "_tie"]


def _sorted(events: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """(events with their range partition ``_block`` and the last version at or before them in
    it (``_here``), the last version of all earlier partitions (``_seed``) by ``_block``)."""
    # Facts of one key and instant are told apart by a hash, so that they can be split, too.
    ranged = events.repartitionByRange(range_partitions(rows, events.sparkSession), *_ORDER)
    ranged = stage(ranged.withColumn("_block", F.spark_partition_id()), "sweep")
    so_far = Window.partitionBy("_block").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    version = F.when(F.col("_kind") == 0, F.struct("_k", "_t", "_to", "_sk"))
    here = ranged.withColumn("_here", F.last(version, ignorenulls=True).over(so_far))
    ends = ranged.groupBy("_block").agg(F.max(version).alias("_end"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    return here, ends.select("_block", F.last("_end", ignorenulls=True).over(earlier).alias("_seed"))


def _versions(versions: DataFrame, key: str, surrogate_key: str) -> DataFrame:
    """Version events; windows that hold no instant are left out."""
    rows = versions.where(F.col("valid_to") > F.col("valid_from"))
    return rows.select(F.col(key).alias("_k"), F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"), F.col(surrogate_key).cast("long").alias("_tie"),
                       F.col("valid_to").alias("_to"), F.col(surrogate_key).alias("_sk"))


def overlapping_keys(versions: DataFrame, key: str, surrogate_key: str = "sk") -> DataFrame:
    """The keys with two windows that overlap: sorted, some window begins before the one before it ends."""
    events = stage(_versions(versions, key, surrogate_key), "sweep_versions")
    here, seeds = _sorted(events, row_count(events))
    before = Window.partitionBy("_block").orderBy(*_ORDER)
    last = F.coalesce(F.lag("_here").over(before), F.col("_seed"))
    pairs = here.join(F.broadcast(seeds), "_block").withColumn("_last", last)
    return pairs.where((F.col("_last._k") == F.col("_k")) & (F.col("_last._to") > F.col("_t"))).select(F.col("_k").alias(key)).distinct()


def as_at_sweep(facts: DataFrame, versions: DataFrame, fact_key: str, dim_key: str, event_ts: str,
                surrogate_key: str = "sk", out_col: str = "customer_sk", unknown_sk: int = -1) -> DataFrame:
    """``facts`` with ``out_col``: the surrogate key of the version live at ``event_ts``, else ``unknown_sk``.

    ``versions`` (key, surrogate key, valid_from, valid_to) must have no overlapping windows.
    Facts with a null key or time get ``unknown_sk``.
    """
    row = F.struct(*[F.col(c) for c in facts.columns])
    events = _versions(versions, dim_key, surrogate_key).unionByName(
        facts.select(F.col(fact_key).alias("_k"), F.col(event_ts).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(*facts.columns).alias("_tie"), row.alias("_row")),
        allowMissingColumns=True)
    here, seeds = _sorted(events, row_count(facts) + row_count(versions))
    last = F.coalesce("_here", "_seed")
    found = here.where(F.col("_kind") == 1).join(F.broadcast(seeds), "_block").withColumn("_last", last)
    live = (F.col("_last._k") == F.col("_k")) & (F.col("_t") < F.col("_last._to"))
    return found.select("_row.*", F.coalesce(F.when(live, F.col("_last._sk")), F.lit(unknown_sk)).cast("long").alias(out_col))
