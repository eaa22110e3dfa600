"""Fact staging: as-at surrogate resolution, measures, merge by natural key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expressions import date_key, gross_amount, net_amount, ts_literal
from tidemark.operators.joins import rows_with_keys, skew_safe_join
from tidemark.operators.sweep import as_at_sweep, overlapping_keys
from tidemark.session import fits_broadcast, known_rows, row_count, stage, with_known_rows

# Keys with more versions than this are resolved by a sweep instead of a join.
SWEEP_VERSIONS = 16


class FactKeyError(ValueError):
    """Staged facts would break the fact's primary key."""


class FactNullError(ValueError):
    """Staged facts hold a NULL where the fact table allows none."""


def null_metrics() -> list:
    """Aggregates (one per NOT NULL column) to observe while facts are staged."""
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in schemas.NOT_NULL["fact_order_line"] if c != "loaded_at"]


def check_nulls(observed: dict) -> None:
    bad = {k.removeprefix("null_"): v for k, v in observed.items() if k.startswith("null_") and v}
    if bad:
        raise FactNullError("NULL in staged facts: " + ", ".join(f"{c} ({n})" for c, n in sorted(bad.items())))


def as_at_join(facts: DataFrame, dim: DataFrame, fact_key: str = "customer_id",
               dim_key: str = "customer_id", event_ts: str = "order_ts",
               surrogate_key: str = "sk", out_col: str = "customer_sk",
               unknown_sk: int = schemas.UNKNOWN_SK) -> DataFrame:
    """Attach the surrogate key of the version live at ``event_ts``.

    Left outer on the business key with the half-open validity range as a
    residual; facts with no live version get ``unknown_sk``. Keys with more than
    ``SWEEP_VERSIONS`` versions are resolved by a sorted sweep, so no fact meets
    more versions than that. (If such a key's windows overlap, which the checks
    report, its facts fan out in the join like any other's.) For the others, the
    dimension is broadcast when its size is checked and bounded; otherwise hot
    business keys are split off and joined against a broadcast of their versions.
    """
    versions = dim.select(F.col(dim_key).alias("_d_key"), F.col(surrogate_key).alias("_d_sk"),
                          F.col("valid_from").alias("_d_from"), F.col("valid_to").alias("_d_to"))
    if known_rows(dim) is not None:
        versions = with_known_rows(versions, known_rows(dim))

    def in_window():
        return (F.col(event_ts) >= F.col("_d_from")) & (F.col(event_ts) < F.col("_d_to"))

    def joined(rows, partners):
        found = skew_safe_join(rows, partners, [fact_key], ["_d_key"], "left", residual=in_window)
        return found.select(*facts.columns, F.coalesce(F.col("_d_sk"), F.lit(unknown_sk)).cast("long").alias(out_col))

    deep = stage(dim.groupBy(F.col(dim_key).alias("_deep")).agg(F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_n") > SWEEP_VERSIONS).select("_deep"), "deep_keys")
    if not row_count(deep):
        return joined(facts, versions)
    if known_rows(facts) is None:
        facts = stage(facts, "as_at_facts")  # split twice below
    own = versions.join(_hinted(deep), F.col("_d_key") == F.col("_deep"), "left_semi")
    own = stage(own.select(F.col("_d_key").alias(dim_key), F.col("_d_sk").alias(surrogate_key),
                           F.col("_d_from").alias("valid_from"), F.col("_d_to").alias("valid_to")), "deep_versions")
    overlapping = stage(overlapping_keys(own, dim_key, surrogate_key).select(F.col(dim_key).alias("_over")), "overlapping_keys")
    if row_count(overlapping):
        deep = stage(deep.join(_hinted(overlapping), F.col("_deep") == F.col("_over"), "left_anti"), "deep_keys")
        own = stage(own.join(_hinted(overlapping), F.col(dim_key) == F.col("_over"), "left_anti"), "deep_versions")
    in_sweep = F.col(fact_key) == F.col("_deep")
    swept = as_at_sweep(stage(facts.join(_hinted(deep), in_sweep, "left_semi"), "deep_facts"), own, fact_key, dim_key,
                        event_ts, surrogate_key, out_col, unknown_sk)
    rest = versions.join(_hinted(deep), F.col("_d_key") == F.col("_deep"), "left_anti")
    return joined(facts.join(_hinted(deep), in_sweep, "left_anti"), rest).unionByName(swept)


def _hinted(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if fits_broadcast(keys) else keys


def inferred_members(staged: DataFrame, dim: DataFrame, fact_key: str = "customer_id",
                     dim_key: str = "customer_id") -> DataFrame:
    """One row ``inferred``: staged facts whose key is absent from every version.

    Facts are counted per key first (map-side), so the anti join sees one row
    per key however hot a key is.
    """
    per_key = staged.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    # Which of the staged keys the dimension has: it is scanned through their
    # broadcast, or through a bitmap of them, and never shuffled whole.
    per_key = stage(per_key, "staged_keys")
    keys = rows_with_keys(dim.select(F.col(dim_key).alias("_k")), "_k", per_key).distinct()
    missing = per_key.join(_hinted(stage(keys, "found_keys")), "_k", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("inferred"))


def stage_facts(order_lines: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Staged order lines -> fact rows (without ``loaded_at``)."""
    resolved = as_at_join(order_lines, dim_customer)
    return resolved.select(
        "order_line_id", "order_id",
        date_key(F.col("order_ts")).alias("order_date_key"),
        "customer_sk", "product_id", "quantity", "unit_price", "discount_pct",
        gross_amount(F.col("quantity"), F.col("unit_price")).alias("gross_amount"),
        net_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct")).alias("net_amount"),
        F.col("updated_at").alias("source_updated_at"),
    )


def staged_rows(loaded: DataFrame) -> DataFrame:
    """Fact rows as staged, without the load's stamp."""
    return with_known_rows(loaded.drop("loaded_at"), row_count(loaded))


def duplicate_keys(df: DataFrame, key: str = "order_line_id") -> int:
    """How many key values occur more than once (0 when the key is unique)."""
    return int(df.groupBy(key).count().where(F.col("count") > 1).count())


def rows_of_keys(fact: DataFrame, staged_facts: DataFrame, key: str = "order_line_id") -> DataFrame:
    """The fact's rows whose key is staged, which a merge supersedes."""
    return rows_with_keys(fact, key, staged_facts)


def merge_facts(fact: DataFrame, staged_facts: DataFrame, loaded_at: datetime,
                key: str = "order_line_id") -> DataFrame:
    """Delete-then-insert on the natural key: the result holds every fact not
    restaged, plus the staged rows stamped ``loaded_at``. Idempotent."""
    keys = staged_facts.select(key)
    kept = fact.join(F.broadcast(keys) if fits_broadcast(staged_facts) else keys, key, "left_anti")
    new_rows = staged_facts.withColumn("loaded_at", ts_literal(loaded_at))
    return kept.unionByName(new_rows.select(*fact.columns))
