"""Slowly changing dimensions: Type 1 overwrite and Type 2 history.

Both loaders join the staged rows to the target's versions of their keys and
reduce each key to a count and booleans (hash aggregates), then derive the next
snapshot of the dimension as a DataFrame. Nothing is updated in place: the
caller publishes the returned snapshot.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expressions import as_at_condition, null_safe_difference, ts_literal
from tidemark.operators.joins import rows_with_keys
from tidemark.operators.keys import assign_dense_keys
from tidemark.session import broadcast_bound, fits_broadcast, observed, range_partitions, stage

NEW, CHANGED, UNCHANGED, NO_CURRENT = "new", "changed", "unchanged", "no_current"


@dataclass
class LoadStats:
    inserted: int = 0
    updated: int = 0
    versioned: int = 0
    unchanged: int = 0
    # Keys whose versions are all closed: neither new nor changed, skipped.
    no_current: int = 0


@dataclass
class Type2Result:
    dimension: DataFrame
    classified: DataFrame
    closed: DataFrame
    opened: DataFrame
    stats: LoadStats = field(default_factory=LoadStats)


@dataclass
class Type1Result:
    dimension: DataFrame
    classified: DataFrame
    overwritten: DataFrame
    inserted: DataFrame
    stats: LoadStats = field(default_factory=LoadStats)


class StagingKeyError(ValueError):
    """Staged rows violate the source's primary key (null or duplicate key)."""


def current_versions(dim: DataFrame) -> DataFrame:
    """The live version of each key: ``WHERE is_current``."""
    return dim.where(F.col("is_current"))


def as_at(dim: DataFrame, moment: datetime) -> DataFrame:
    """The version of each member that was live at ``moment`` (half-open)."""
    return dim.where(as_at_condition(moment))


def _versions_of_staged(target: DataFrame, staging: DataFrame, business_key: str) -> DataFrame:
    """Target rows whose key is staged; the target is scanned through a broadcast
    of the keys or of a bitmap of them, never shuffled whole."""
    return rows_with_keys(target, business_key, staging)


def _staged_beside_target(target: DataFrame, staging: DataFrame, business_key: str,
                          attributes: Sequence[str]) -> DataFrame:
    """Each staged row beside every target row of its key (left join), with how
    often its key is staged and whether the attributes differ (null-safe)."""
    bk = business_key
    counted = staging.groupBy(bk).agg(F.count(F.lit(1)).alias("n_staged"))
    staged = staging.select(bk, *attributes).join(
        counted.withColumnRenamed(bk, "_k"), F.col(bk).eqNullSafe(F.col("_k"))).drop("_k")
    rows = _versions_of_staged(target, staging, bk)
    differs = null_safe_difference(attributes, "t", "s")
    return staged.alias("s").join(rows.alias("t"), F.col(f"s.{bk}") == F.col(f"t.{bk}"), "left").select(
        *[F.col(f"s.{c}").alias(c) for c in (bk, *attributes)], "n_staged",
        F.col(f"t.{bk}").isNotNull().alias("_there"), differs.alias("_differs"),
        *([F.col("t.is_current").alias("_live")] if "is_current" in target.columns else []))


def classify_type2(dim: DataFrame, staging: DataFrame, business_key: str,
                   attributes: Sequence[str]) -> DataFrame:
    """One row per staged key: its staged attributes, ``action`` and ``n_staged``.

    ``new``: no version at all; ``no_current``: versions, none current;
    ``changed``: some current version differs (null-safe) from the staged row;
    ``unchanged``: every current version equals it. Several current versions
    (a defect) compare as changed when any of them differs. The aggregates are
    a count and two booleans, so grouping hashes and never sorts.
    """
    live = F.col("_there") & F.col("_live")
    grouped = _staged_beside_target(dim, staging, business_key, attributes).groupBy(
        business_key, *attributes, "n_staged").agg(
        F.count_if("_there").alias("_n"), F.coalesce(F.bool_or(live), F.lit(False)).alias("_any"),
        F.coalesce(F.bool_or(live & F.col("_differs")), F.lit(False)).alias("_changed"))
    action = (F.when(F.col("_n") == 0, NEW).when(~F.col("_any"), NO_CURRENT)
              .when(F.col("_changed"), CHANGED).otherwise(UNCHANGED))
    return grouped.select(business_key, *attributes, action.alias("action"), F.col("n_staged").cast("long").alias("n_staged"))


def classify_type1(target: DataFrame, staging: DataFrame, business_key: str,
                   attributes: Sequence[str]) -> DataFrame:
    """One row per staged key with ``action`` new / changed / unchanged."""
    grouped = _staged_beside_target(target, staging, business_key, attributes).groupBy(
        business_key, *attributes, "n_staged").agg(
        F.count_if("_there").alias("n_target"),
        F.coalesce(F.bool_or(F.col("_there") & F.col("_differs")), F.lit(False)).alias("_changed"))
    action = F.when(F.col("n_target") == 0, NEW).when(F.col("_changed"), CHANGED).otherwise(UNCHANGED)
    return grouped.select(business_key, *attributes, action.alias("action"), F.col("n_staged").cast("long").alias("n_staged"),
                          F.col("n_target").cast("long").alias("n_target"))


def _action_metrics(business_key: str) -> list:
    return [*[F.count_if(F.col("action") == a).alias(a) for a in (NEW, CHANGED, UNCHANGED, NO_CURRENT)],
            F.count_if(F.col("n_staged") > 1).alias("duplicate_keys"),
            F.count_if(F.col(business_key).isNull()).alias("null_keys")]


def action_counts(classified: DataFrame, business_key: str) -> dict:
    """Counts per action plus key-integrity counts (observed while staging the
    classification, else one small aggregate)."""
    seen = observed(classified)
    if seen:
        return seen
    return classified.agg(*_action_metrics(business_key)).collect()[0].asDict()


def _stage_classified(df: DataFrame, business_key: str, name: str) -> DataFrame:
    return stage(df, name, _action_metrics(business_key))


def _check_keys(counts: dict, business_key: str) -> None:
    if counts["null_keys"]:
        raise StagingKeyError(f"staged rows with a NULL {business_key}")
    if counts["duplicate_keys"]:
        raise StagingKeyError(f"{counts['duplicate_keys']} {business_key} value(s) staged more than once")


def load_type_2(dim: DataFrame, staging: DataFrame, business_key: str, attributes: Sequence[str],
                effective_at: datetime, surrogate_key: str = "sk",
                initial_from: datetime = schemas.BEGINNING_OF_TIME,
                num_partitions: int | None = None,
                surrogate_base: int | None = None) -> Type2Result:
    """Close changed current versions and open new ones; returns the next snapshot.

    New members open at ``initial_from``, changed members at ``effective_at``;
    the closed version's ``valid_to`` equals the new ``valid_from``. New keys
    take the lower surrogate keys, changed keys the next, each in key order,
    after ``coalesce(max(sk), 0)`` (or ``surrogate_base`` when the caller
    passes only part of the dimension, e.g. the buckets its keys fall in).
    """
    bk = business_key
    classified = _stage_classified(classify_type2(dim, staging, bk, attributes), bk, "classified_type2")
    counts = action_counts(classified, bk)
    _check_keys(counts, bk)
    stats = LoadStats(inserted=counts[NEW], versioned=counts[CHANGED],
                      unchanged=counts[UNCHANGED], no_current=counts[NO_CURRENT])

    end = ts_literal(schemas.END_OF_TIME)
    n_open = counts[NEW] + counts[CHANGED]
    to_open = classified.where(F.col("action").isin(NEW, CHANGED)).withColumn(
        "_action_order", F.when(F.col("action") == NEW, F.lit(0)).otherwise(F.lit(1)))
    if n_open:
        base = surrogate_base if surrogate_base is not None else dim.agg(
            F.coalesce(F.max(surrogate_key), F.lit(0)).cast("long").alias("b")).collect()[0]["b"]
        keyed = assign_dense_keys(to_open, ["_action_order", bk], base, surrogate_key,
                                  num_partitions or range_partitions(n_open, dim.sparkSession))
    else:
        keyed = to_open.withColumn(surrogate_key, F.lit(None).cast("long"))
    opened = keyed.select(
        F.col(surrogate_key), F.col(bk), *[F.col(a) for a in attributes],
        F.when(F.col("action") == NEW, ts_literal(initial_from)).otherwise(ts_literal(effective_at)).alias("valid_from"),
        end.alias("valid_to"), F.lit(True).alias("is_current"))

    changed_keys = classified.where(F.col("action") == CHANGED).select(F.col(bk), F.lit(True).alias("_chg"))
    # The changed-key count is known, so the broadcast check costs no job.
    small = counts[CHANGED] <= broadcast_bound()  # keys only, so rows bound the bytes
    marked = dim.join(F.broadcast(changed_keys) if small else changed_keys, bk, "left")
    closing = F.col("is_current") & F.coalesce(F.col("_chg"), F.lit(False))
    dim_cols = dim.columns
    kept_and_closed = marked.select(*[
        F.when(closing, ts_literal(effective_at)).otherwise(F.col("valid_to")).alias("valid_to") if c == "valid_to"
        else F.when(closing, F.lit(False)).otherwise(F.col("is_current")).alias("is_current") if c == "is_current"
        else F.col(c)
        for c in dim_cols], closing.alias("_closing"))
    closed = kept_and_closed.where(F.col("_closing")).drop("_closing")
    # Further columns of the target are null on the rows opened here.
    dimension = kept_and_closed.drop("_closing").unionByName(opened, allowMissingColumns=True)
    opened = closed.limit(0).unionByName(opened, allowMissingColumns=True)
    return Type2Result(dimension=dimension, classified=classified, closed=closed, opened=opened, stats=stats)


def load_type_1(target: DataFrame, staging: DataFrame, business_key: str, attributes: Sequence[str],
                loaded_at: datetime, stamp_column: str = "updated_at") -> Type1Result:
    """Overwrite changed rows, insert new ones, leave equal rows untouched.

    ``loaded_at`` stamps every row written (the load's run timestamp).
    ``unchanged`` is left at 0 and ``updated`` counts overwritten keys.
    """
    bk = business_key
    classified = _stage_classified(classify_type1(target, staging, bk, attributes), bk, "classified_type1")
    counts = action_counts(classified, bk)
    _check_keys(counts, bk)
    stats = LoadStats(inserted=counts[NEW], updated=counts[CHANGED])

    stamp = ts_literal(loaded_at)
    changes = classified.where(F.col("action") == CHANGED).select(
        F.col(bk), *[F.col(a).alias(f"_s_{a}") for a in attributes], F.lit(True).alias("_chg"))
    marked = target.join(F.broadcast(changes) if fits_broadcast(classified) else changes, bk, "left")
    hit = F.coalesce(F.col("_chg"), F.lit(False))
    cols = []
    for c in target.columns:
        if c in attributes:
            cols.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c == stamp_column:
            cols.append(F.when(hit, stamp).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    updated = marked.select(*cols, hit.alias("_hit"))
    overwritten, updated = updated.where(F.col("_hit")).drop("_hit"), updated.drop("_hit")
    inserted = classified.where(F.col("action") == NEW).select(
        F.col(bk), *[F.col(a) for a in attributes], stamp.alias(stamp_column))
    # Further columns of the target are null on the rows inserted here.
    inserted = updated.limit(0).unionByName(inserted, allowMissingColumns=True)
    return Type1Result(dimension=updated.unionByName(inserted), classified=classified,
                       overwritten=overwritten, inserted=inserted, stats=stats)


def latest_per_key(df: DataFrame, business_key: str, order_by: str = "updated_at") -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (ties broken by
    the greatest whole row, so the result is deterministic).

    For callers whose staging may repeat a key (the loaders reject that). An
    aggregation with ``max_by`` (map-side partial), not a per-key window, so a
    heavily repeated key cannot pin one task.
    """
    others = [c for c in df.columns if c != business_key]
    row = F.struct(*[F.col(c) for c in others])
    order = F.struct(F.col(order_by), row)
    return (df.groupBy(business_key).agg(F.max_by(row, order).alias("_r"))
            .select(business_key, *[F.col(f"_r.{c}").alias(c) for c in others])
            .select(*df.columns))


def unknown_member(spark, schema=schemas.DIM_CUSTOMER) -> DataFrame:
    """The one-row Unknown member: SK -1, key UNKNOWN, attributes Unknown."""
    row = {}
    for f in schema.fields:
        if f.name == "sk":
            row[f.name] = schemas.UNKNOWN_SK
        elif f.name == "customer_id":
            row[f.name] = schemas.UNKNOWN_BK
        elif f.name == "valid_from":
            row[f.name] = schemas.BEGINNING_OF_TIME
        elif f.name == "valid_to":
            row[f.name] = schemas.END_OF_TIME
        elif f.name == "is_current":
            row[f.name] = True
        else:
            row[f.name] = schemas.UNKNOWN_LABEL
    return spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)


def seed_unknown_member(dim: DataFrame) -> DataFrame:
    """Add the Unknown member unless a row with its SK exists."""
    unknown = unknown_member(dim.sparkSession, dim.schema)
    missing = unknown.join(dim.select("sk"), "sk", "left_anti")
    return dim.unionByName(missing.select(*dim.columns))
